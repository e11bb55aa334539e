"""Pages to listings: one Arrow pass that parses a page once and resolves its twelve fields.

A field's tiers are tried in order of confidence; the first value wins. A field
whose resolver fails is empty and doesn't touch the others.
"""

from __future__ import annotations

import html as entities
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache
from urllib.parse import unquote, urlsplit

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from gleaner import vocabulary as v
from gleaner.functions.dialect import SPARK, apply, keep
from gleaner.functions.url import url_steps
from gleaner.html import Node, parse
from gleaner.operators.classify import publishable
from gleaner.sources.suffixes import with_domain

FIELDS = ["price", "reference_id", "property_type", "surface_area", "rooms", "bedrooms", "dpe_rating", "location", "coordinates", "phone_number", "email", "agent_name"]


@lru_cache(None)
def rx(pattern: str) -> re.Pattern[str]:
    return re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: chr(int(m[1], 16)), pattern))


def collapse(s: str | None) -> str:
    return " ".join((s or "").split())


def fold(s: str | None) -> str:
    """Without accents, collapsed, in lower case."""
    return collapse("".join(c for c in unicodedata.normalize("NFKD", s or "") if not unicodedata.combining(c))).lower()


# --- JSON-LD ---------------------------------------------------------------


def load_json(raw: str):
    """Strict JSON, else with commas before closing brackets taken out, else None."""
    for text in (raw.strip(), re.sub(r",\s*([}\]])", r"\1", raw.strip())):
        try:
            return json.loads(text)
        except ValueError:
            continue
    return None


class LinkedData(dict):
    """Flat facts from JSON-LD trees, depth first; what is found first stays."""

    def absorb(self, node) -> LinkedData:
        if isinstance(node, list):
            for x in node:
                self.absorb(x)
        elif isinstance(node, dict):
            kind = node.get("@type") or node.get("type") or ""
            kind = kind.lower() if isinstance(kind, str) else ""
            if kind in v.LD_LISTING_TYPES:
                self._price(node)
            for key, value in node.items():
                self._pair(str(key).lower(), value)
            name = node.get("name")
            if kind in v.LD_AGENT_TYPES and isinstance(name, str) and name.strip():
                self.setdefault("agent_name", name.strip())
        return self

    def _pair(self, key: str, value) -> None:
        named = {**dict.fromkeys(v.LD_PHONES, "phone"), **dict.fromkeys(v.LD_DPE, "dpe"), **dict.fromkeys(v.LD_REFERENCES, "reference_id"), "name": "name", "description": "description", "url": "url", "@id": "url"}
        if key == "address":
            if isinstance(value, dict):
                value = f"{value.get('addressLocality') or value.get('addresslocality') or ''} {value.get('postalCode') or value.get('postalcode') or ''}"
            if isinstance(value, str) and value.strip():
                self.setdefault("location", value.strip())
        elif key == "geo" and isinstance(value, dict):
            lat, lng = (value.get(a) or value.get(b) for a, b in (("latitude", "lat"), ("longitude", "lng")))
            if lat and lng:
                self.setdefault("coordinates", f"{lat}, {lng}")
        elif key in named and isinstance(value, str):
            self.setdefault(named[key], value)
        else:
            if key in v.LD_AGENT_PARENTS and (name := self._agent(value)):
                self.setdefault("agent_name", name)
            self.absorb(value)

    def _agent(self, value) -> str:
        if isinstance(value, str):
            return value.strip()
        if isinstance(value, list):
            return next((name for x in value if (name := self._agent(x))), "")
        if isinstance(value, dict):
            kind = value.get("@type") or value.get("type") or ""
            if isinstance(kind, str) and kind and kind.lower() not in v.LD_AGENT_TYPES:
                return ""
            name = value.get("name")
            return name.strip() if isinstance(name, str) else ""
        return ""

    def _price(self, node: dict) -> None:
        offers = node.get("offers")
        for holder in [*(offers if isinstance(offers, list) else [offers]), node]:
            if isinstance(holder, dict):
                found = next((holder[k] for k in v.LD_PRICES if holder.get(k) not in (None, "")), None)
                if found is not None:
                    self.setdefault("price", str(found))
                    return


# --- the page --------------------------------------------------------------


@dataclass
class Page:
    url: str
    html: str
    job: dict[str, str] = field(default_factory=dict)

    @cached_property
    def tree(self) -> Node:
        return parse(self.html)

    def _text(self, selector: str) -> str:
        node = self.tree.first(selector) if self.html else None
        return collapse(node.text()) if node else ""

    @cached_property
    def title(self) -> str:
        return self._text("title")

    @cached_property
    def h1(self) -> str:
        return self._text("h1")

    @cached_property
    def text(self) -> str:
        if not self.html:
            return ""
        return collapse((self.tree.first("body") or self.tree).text())

    @cached_property
    def ld(self) -> LinkedData:
        out = LinkedData()
        for script in self.tree.select('script[type="application/ld+json"]') if self.html else ():
            out.absorb(load_json("".join(script.pieces())))
        return out

    def is_detail(self, crumbs: str) -> bool:
        if any(self.ld.get(k) for k in ("price", "reference_id", "description", "name")) or rx(v.DETAIL_URL).search(self.url):
            return True
        return any(len(n.select("li, a")) >= 3 for n in self.tree.select(crumbs)) if self.html else False


Tiers = Iterator[str]


def _first_match(patterns: list[str], text: str, accept: Callable[[str], str]) -> Tiers:
    for p in patterns:
        if m := rx(p).search(text):
            yield accept(m[1])


# --- prices ----------------------------------------------------------------


def clean_price(raw: str) -> str:
    m = rx(r"\d[\d\s\x{a0}.,]*").search(raw or "")
    runs = re.findall(r"\d+", m[0]) if m else []
    digits = "".join(runs)
    if not digits or digits in ("0", "00", "000") or len(digits) > 9:
        return ""
    grouped = len(runs[0]) <= 3 and all(len(r) == 3 for r in runs[1:])
    return "" if len(runs) > 1 and len(digits) > 7 and not grouped else digits


def _in_range(digits: str) -> str:
    return digits if digits and v.LEAST_PRICE <= int(digits) <= v.MOST_PRICE else ""


def accept_price(text: str, around: str = "", sale: bool = False, marked: bool = False, no_rent: bool = False) -> str:
    on = lambda p: bool(rx(p).search(text) or rx(p).search(around))
    if not text or rx(v.ON_REQUEST).search(text) or on(v.PER_AREA) or (no_rent and on(v.RENT)) or (sale and not rx(v.SALE).search(around)):
        return ""
    labelled = on(v.CURRENCY_OR_LABEL)
    digits = _in_range(clean_price(text))
    return "" if not labelled and (marked or len(digits) <= v.SMALL_DIGITS) else digits


def price(p: Page) -> Tiers:
    yield _in_range(clean_price(str(p.ld.get("price") or "")))
    for selector in v.PRICE_SELECTORS if p.html else ():
        for node in p.tree.select(selector):
            around = node.parent.text() if node.parent else ""
            held = next((node.attrs[a] for a in v.PRICE_ATTRIBUTES if node.attrs.get(a)), "")
            for text in (held, node.text()):
                yield accept_price(text, around, marked=True)
    for m in rx(v.PRICE_LABEL).finditer(p.text):
        yield accept_price(m[1], m[1])
    for m in rx(v.EURO_AMOUNT).finditer(p.text):
        yield accept_price(m[1] + " €", p.text[max(0, m.start() - v.AROUND) : m.end() + v.AROUND], sale=True, no_rent=True)


# --- references and kinds --------------------------------------------------


def _junk(s: str) -> bool:
    return any(t in s.lower() for t in v.JUNK_TOKENS)


def _slug_shaped(s: str) -> bool:
    return 0 < len(s) <= v.LONGEST_SLUG and s.count("-") <= v.MOST_HYPHENS and not s.isdigit() and bool(re.search(r"\d", s) or re.match(v.ACRONYM, s))


def _identifier(s: str) -> bool:
    return len(s) >= 3 and bool(re.search(v.IDENTIFIER, s))


def accept_label(raw: str) -> str:
    s = raw.strip().strip(".,;:")
    return s if not _junk(s) and _identifier(s) and _slug_shaped(s) else ""


def slug_reference(url: str) -> str:
    last = urlsplit(url).path.rstrip("/").rpartition("/")[2].partition(";")[0]
    if "+" in last:
        return ""
    stem, comma, end = last.rpartition(",")
    if comma:
        stem, end = stem.strip(".,;:"), end.strip(".,;:")
        fits = len(end) >= 3 and not _junk(stem) and not _junk(end) and (not stem or _identifier(stem)) and _slug_shaped(end)
        return end if fits and stem.split("-")[0].lower() not in v.UI_VERBS else ""
    last = last.strip(".,;:")
    name = last.rpartition(".")[0] if "." in last else last
    fits = len(last) >= 3 and not _junk(last) and not re.match(v.NAV_ROOT, name) and _identifier(name) and _slug_shaped(name)
    return last if fits and name.split("-")[0].lower() not in v.UI_VERBS else ""


def reference_id(p: Page) -> Tiers:
    yield accept_label(p.ld.get("reference_id", ""))
    yield from _first_match(v.REFERENCE_LABELS, p.text, accept_label)
    yield from _first_match([v.REFERENCE_CODE, *v.REFERENCE_TAILS], p.url, str)
    yield slug_reference(p.url)


_TERMS = sorted((rank, -len(s), s, name) for name, rank, synonyms in v.PROPERTY_TYPES for s in synonyms)


def best_type(text: str) -> str:
    text = fold(text)
    return next((name for _, _, s, name in _TERMS if s in text), "")


def property_type(p: Page) -> Tiers:
    path = urlsplit(p.url).path.lower()
    yield next((name for pattern, name in v.PROPERTY_SEGMENTS if rx("(?i)" + pattern).search(path)), "")
    for text in (p.title, p.h1, p.ld.get("name", ""), p.ld.get("description", ""), p.url):
        yield best_type(text)


# --- numbers ---------------------------------------------------------------


def clean_surface(raw: str) -> str:
    s = raw.replace("\xa0", " ").strip().replace(" ", "")
    dotted = s.replace(",", ".")
    whole, dot, part = dotted.rpartition(".")
    if dotted.count(".") > 1:
        dotted = whole.replace(".", "") + "." + part
    elif dot and "," not in s and len(part) == 3 and part.isdigit() and whole.isdigit():
        dotted = whole + part
    return "" if dotted.startswith(".") else dotted


def surface_area(p: Page) -> Tiers:
    yield from _first_match([v.SURFACE_LABEL, v.SURFACE_LOOSE], p.text, clean_surface)


def _count(p: Page, pattern: str, least: int, minus: int) -> Tiers:
    if m := rx(pattern).search(p.text):
        n = int(m[1] or m[2])
        yield str(n) if least <= n <= 30 else ""
    if m := rx(v.T_ROOMS).search(f"{p.title} {p.h1} {p.url}"):
        yield str(int(m[1]) - minus) if 1 <= int(m[1]) <= 30 else ""


def rooms(p: Page) -> Tiers:
    yield from _count(p, v.ROOMS, 1, 0)


def bedrooms(p: Page) -> Tiers:
    yield from _count(p, v.BEDROOMS, 0, 1)


def _letter(s: str | None) -> str:
    s = (s or "").strip().upper()
    return s if len(s) == 1 and s in "ABCDEFG" else ""


def dpe_rating(p: Page) -> Tiers:
    m = re.search(r"(?i)\b([A-G])\b", p.ld.get("dpe", ""))
    yield _letter(m and m[1])
    if p.html:
        for node in p.tree.select(", ".join(f"[{a}]" for a in v.DPE_ATTRIBUTES)):
            for a in v.DPE_ATTRIBUTES:
                yield _letter(node.attrs.get(a))
        scope = p.tree.select(v.DPE_SCOPE)
        for node in scope:
            m = rx(v.DPE_CLASS).search(node.attrs.get("class", "").strip())
            yield _letter(m and m[1])
        for node in scope:
            text = node.text(deep=False) or node.text()
            yield _letter(text.strip(".:- ")) if len(text) <= 3 else ""
        for node in p.tree.select("img[alt]"):
            m = rx(v.DPE_ALT).search(node.attrs["alt"])
            yield _letter(m and m[1])
    yield from _first_match(v.DPE_LABELS, fold(p.text), _letter)


# --- places ----------------------------------------------------------------


def descriptor(s: str) -> bool:
    return bool(rx(v.DESCRIPTOR).search(s) or re.search(r"(?i)\br[ée]f\b", s) or len(re.findall(r"\d{2,}", s)) >= 2)


def place_like(s: str) -> bool:
    s = collapse(s)
    if not 3 <= len(s) <= 60 or fold(s) in v.NAV_LABELS or descriptor(s) or not re.search(r"[A-Za-zÀ-ſ]", s) or sum(c.isdigit() for c in s) > len(s) / 2:
        return False
    words = [w for w in re.split(r"[\s\-]+", s) if re.match(r"[A-Za-zÀ-ſ]", w)]
    return len(words) <= 6 and not (words and all(fold(w) in v.NAV_LABELS or fold(w) in v.PROPERTY_TOKENS for w in words))


def _commune(s: str) -> str:
    s = collapse(s).strip(" -–—,»")
    return s if s and place_like(s) else ""


def _with_postal(commune: str, postal: str) -> str:
    return f"{c} {postal}" if (c := _commune(commune)) else ""


def url_postal(url: str) -> str:
    m = rx(v.URL_POSTAL).search(url)
    last = (m[1] or m[4] or "").rpartition("-")[2] if m else ""
    return f"{last.capitalize()} {m[2] or m[3]}" if last and fold(last) not in v.PROPERTY_TOKENS else ""


def url_commune(url: str) -> str:
    """The rightmost path segment that is left with words once numbers, types, categories and labels are gone."""
    if "+" in url.partition("?")[0]:
        return ""
    segments = [s for s in unquote(urlsplit(url).path).lower().split("/") if s]
    if not any(c in s for s in segments for c in v.URL_CATEGORIES):
        return ""
    drop = lambda t: t.isdigit() or re.match(r"^t\d+$", t) or fold(t) in v.PROPERTY_TOKENS or fold(t) in v.NAV_LABELS or t in v.URL_CATEGORIES
    for s in reversed(segments):
        head, _, tail = s.partition("-")
        s = (tail if head.isdigit() and tail else s).split(".")[0]
        words = [t for t in re.split(r"[-_]", s) if t and not drop(t)]
        if not words or any("%" in t or rx(v.SLUG_DESCRIPTOR).search(t) for t in words):
            continue
        joined = " ".join(t.capitalize() for t in words)
        if 3 <= len(joined) <= 60 and fold(joined) not in v.NAV_LABELS:
            return joined
    return ""


def location(p: Page) -> Tiers:
    s = collapse(p.ld.get("location", ""))
    yield s if len(s) >= 3 and fold(s) not in v.NAV_LABELS and not descriptor(s) else ""
    yield url_postal(p.url)
    for text in (p.title, p.h1):
        if m := rx(v.TITLE_AT).search(" " + text):
            yield _commune(m[1])
        if m := rx(v.TITLE_POSTAL_FIRST).search(text):
            yield _with_postal(m[2], m[1])
        if m := rx(v.TITLE_POSTAL_LAST).search(text):
            yield _with_postal(m[1], m[2])
    if p.html:
        crumbs = next((found for n in p.tree.select(v.BREADCRUMB) if (found := [t for i in n.select("li, a, span") if (t := collapse(i.text()))])), [])
        for s in reversed(crumbs):
            yield s if re.search(r"\b\d{5}\b", s) and fold(s) not in v.NAV_LABELS and not descriptor(s) else ""
        for s in reversed(crumbs):
            yield s if place_like(s) else ""
    yield url_commune(p.url)
    if m := rx(v.BODY_POSTAL).search(p.text[: v.BODY_CHARS]):
        yield _with_postal(m[1], m[2])
    for selector in v.PLACE_METAS if p.html else ():
        node = p.tree.first(selector)
        s = node.attrs.get("content", "").strip() if node else ""
        yield s if fold(s) not in v.NAV_LABELS else ""
    if p.job and p.is_detail(v.BREADCRUMB):
        yield collapse(f"{p.job.get('city') or ''} {p.job.get('postalcode') or ''}")


def pair(lat, lng) -> str:
    try:
        a, b = float(str(lat).strip()), float(str(lng).strip())
    except ValueError:
        return ""
    return f"{a}, {b}" if -90 <= a <= 90 and -180 <= b <= 180 and (a or b) else ""


def _map_url(url: str) -> str:
    if not any(w in url for w in ("google", "maps", "openstreetmap")):
        return ""
    return next((found for x in v.MAP_URLS if (m := rx(x).search(url)) and (found := pair(m[1], m[2]))), "")


def coordinates(p: Page) -> Tiers:
    parts = re.split(r"[,\s]+", p.ld.get("coordinates", "").strip(), maxsplit=1)
    yield pair(*parts) if len(parts) == 2 else ""
    if not p.html:
        return
    held = lambda selector: (n.attrs.get("content", "").strip() if (n := p.tree.first(selector)) else "")
    lat, lng = (next((x for s in names if (x := held(s))), "") for names in (v.LAT_METAS, v.LNG_METAS))
    position = re.split("[;,]", held(v.POSITION_META), maxsplit=1)
    yield pair(*position) if not lat and len(position) == 2 else pair(lat, lng)
    for node in p.tree.select(", ".join(f"[{a}]" for a in v.LAT_ATTRIBUTES)):
        yield pair(*(next((node.attrs[a] for a in names if node.attrs.get(a)), "") for names in (v.LAT_ATTRIBUTES, v.LNG_ATTRIBUTES)))
    for node in p.tree.select(", ".join(f"[{a}]" for a in v.PAIR_ATTRIBUTES)):
        for a in v.PAIR_ATTRIBUTES:
            m = rx(v.PAIR).search(node.attrs.get(a, "").strip())
            yield pair(m[1], m[2]) if m else ""
    if m := rx(v.MAPBOX).search(p.html):
        yield pair(m[2], m[1])
    for x in v.LEAFLET:
        if m := rx(x).search(p.html):
            yield pair(m[1], m[2])
    a, b = rx(v.LAT_KEY).search(p.html), rx(v.LNG_KEY).search(p.html)
    yield pair(a[1], b[1]) if a and b else ""
    for selector, name in (("a[href]", "href"), ("iframe[src]", "src")):
        for node in p.tree.select(selector):
            yield _map_url(node.attrs[name].strip())


# --- people ----------------------------------------------------------------


def clean_phone(raw: str | None) -> str:
    raw = (raw or "").strip()
    digits = re.sub(r"\D+", "", raw)
    national = lambda s: "0" + s if len(s) == 9 else ""
    if raw.startswith("+33"):
        return national(digits[2:])
    if digits.startswith("0033"):
        return national(digits[4:])
    if digits.startswith("33") and len(digits) == 11:
        return "0" + digits[2:]
    digits = digits.removeprefix("00") if digits.startswith("00") else digits
    if not 8 <= len(digits) <= 10:
        return ""
    return "0" + digits if len(digits) == 9 and digits[0] != "0" else digits


def phone_number(p: Page) -> Tiers:
    yield clean_phone(p.ld.get("phone"))
    for node in p.tree.select("a[href^='tel:']") if p.html else ():
        yield clean_phone(node.attrs["href"].partition(":")[2])
    yield from _first_match([*v.PHONE_LABELS, v.PHONE_FREE], p.text, clean_phone)
    yield clean_phone(p.job.get("phone"))


def accept_email(s: str) -> str:
    low = s.lower()
    return "" if any(x in low for x in v.EMAIL_REJECTS) or low.startswith(("noreply@", "no-reply@")) else s


def decode_cfemail(payload: str) -> str:
    """Hexadecimal bytes, each but the first exclusive-ored with the first."""
    try:
        key, *rest = bytes.fromhex(payload) if re.fullmatch(r"(?:[0-9a-fA-F]{2}){2,}", payload) else b"\0"
        return bytes(b ^ key for b in rest).decode()
    except UnicodeDecodeError:
        return ""


def email(p: Page) -> Tiers:
    if not p.html:
        return
    for node in p.tree.select("[data-cfemail]"):
        yield accept_email(decode_cfemail(node.attrs["data-cfemail"].strip()))
    for node in p.tree.select("a[href*='/cdn-cgi/l/email-protection']"):
        yield accept_email(decode_cfemail(node.attrs["href"].rpartition("#")[2].strip())) if "#" in node.attrs["href"] else ""
    for node in p.tree.select("a[href^='mailto:']"):
        yield accept_email(entities.unescape(node.attrs["href"]).partition(":")[2].partition("?")[0].strip())
    # whole texts are gone through, wherever they hold what each address has: it is found sooner than a run of letters
    for source in (p.text, p.html):
        for m in rx(v.OBFUSCATED).finditer(source) if rx(v.OBFUSCATED_MARK).search(source) else ():
            yield accept_email(f"{m[1]}@{m[2]}.{m[3]}".lower())
    for m in rx(v.EMAIL).finditer(p.html) if "@" in p.html else ():
        yield accept_email(m[0])


def _bare_name(raw: str | None) -> str:
    s = collapse(raw)
    s = rx(v.HONORIFIC).sub("", s).strip() if len(s) <= v.LONGEST_NAME else ""
    low = fold(s)
    return "" if not low or any(x in low for x in v.NAME_JUNK) or any(c.isdigit() for c in s) else s


def clean_name(raw: str | None) -> str:
    s = _bare_name(raw)
    return s if any(rx(x).match(s) for x in v.NAME_SHAPES) else ""


def listed_name(raw: str | None) -> str:
    """A name from the agency table: one word will do, and lower case is turned into title case."""
    s = _bare_name(raw)
    s = s if re.search("[A-ZÀ-Ý]", s) else s.title()
    return s if re.match("[A-ZÀ-Ý]", s) else ""


def _about_agent(node: Node | None) -> bool:
    for _ in range(v.AGENT_DEPTH):
        if node is None:
            return False
        held = f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()
        if any(x in held for x in v.AGENT_CONTEXT):
            return True
        node = node.parent
    return False


def agent_name(p: Page) -> Tiers:
    yield clean_name(p.ld.get("agent_name"))
    for selector in v.AGENT_SELECTORS if p.html else ():
        for node in p.tree.select(selector):
            if _about_agent(node):
                yield clean_name(next((node.attrs[a] for a in v.AGENT_ATTRIBUTES if node.attrs.get(a)), ""))
                yield clean_name(node.text())
    yield from _first_match(v.AGENT_LABELS, p.text, clean_name)
    if p.job.get("agent_name") and p.is_detail(v.AGENT_BREADCRUMB):
        yield listed_name(p.job["agent_name"])


RESOLVERS: dict[str, Callable[[Page], Tiers]] = {
    f.__name__: f for f in (price, reference_id, property_type, surface_area, rooms, bedrooms, dpe_rating, location, coordinates, phone_number, email, agent_name)
}


Resolver = Callable[[Page], Tiers]


def resolve(page: Page, resolvers: dict[str, Resolver] | None = None, fields: list[str] | None = None) -> dict[str, str | list[str]]:
    """All fields of a page, or those named; a resolver that fails leaves its field empty and its name in ``faults``. Those given replace or add to the known ones."""
    out, faults = {}, []
    for name, resolver in {**RESOLVERS, **(resolvers or {})}.items():
        if fields is not None and name not in fields:
            continue
        try:
            out[name] = next((x for x in resolver(page) if x), "")
        except Exception:  # one field's failure must not take the row with it
            out[name] = ""
            faults.append(name)
    return {**out, "faults": faults}


JOB = ["domain", "agency_name", "agent_name", "phone", "city", "postalcode"]


def extract_fields(pages: DataFrame, resolvers: dict[str, Resolver] | None = None, fields: list[str] | None = None) -> DataFrame:
    """``pages(url, html, job fields)`` with a column for each resolved field and ``faults``, the fields whose resolver failed. Nulls count as empty.

    ``resolvers`` are generators of tiers by field: they replace those of known
    fields, and other fields get columns of their own. With ``fields`` only these are
    resolved and get columns: no field's value depends on another's.
    """
    job = [c for c in JOB if c in pages.columns]
    names = [f for f in (*FIELDS, *(f for f in resolvers or {} if f not in FIELDS)) if fields is None or f in fields]

    @F.pandas_udf(", ".join(f"`{f}` string" for f in names) + ", faults array<string>")
    def run(url: pd.Series, html: pd.Series, jobs: pd.DataFrame) -> pd.DataFrame:
        rows = [resolve(Page(u or "", h or "", {k: x or "" for k, x in j.items()}), resolvers, fields) for u, h, j in zip(url, html, jobs.to_dict("records"), strict=True)]
        return pd.DataFrame(rows, columns=[*names, "faults"])

    made = F.struct(*[F.col(c) for c in job]) if job else F.struct(F.lit("").alias("domain"))
    return pages.withColumn("_fields", run("url", "html", made)).select(*[c for c in pages.columns if c not in (*names, "faults")], "_fields.*")


def extract_listings(pages: DataFrame, resolvers: dict[str, Resolver] | None = None) -> DataFrame:
    """Publishable listings of pages, in the listing's columns after those of the page."""
    agency = F.coalesce("agency_name", F.lit("")) if "agency_name" in pages.columns else F.lit("")
    own = pages.withColumn("_agency", agency).withColumn("_domain", F.col("domain") if "domain" in pages.columns else F.lit(""))
    first = [c for c in pages.columns if c not in v.LISTING_FIELDS]
    return publish(extract_fields(own, resolvers), first)


def publish(rows: DataFrame, first: list[str]) -> DataFrame:
    """Publishable ones of extracted pages: the columns ``first``, then those of a listing. ``_agency`` and ``_domain`` are the job's."""
    rows = apply(rows, url_steps(SPARK, "url"))
    rows = rows.withColumn("agency_name", F.col("_agency")).withColumn("source_url", F.when(F.col("u_canonical") == "", F.col("url")).otherwise(F.col("u_canonical")))
    rows = with_domain(rows, "u_host", "source_domain").withColumn("source_domain", F.coalesce(F.nullif("source_domain", F.lit("")), F.col("_domain")))
    rows = rows.withColumn("_publishable", F.expr(publishable(SPARK)))
    return keep(rows, "_publishable").select(*first, *v.LISTING_FIELDS)
