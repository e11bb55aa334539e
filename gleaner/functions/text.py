"""Text functions as expressions."""

from __future__ import annotations

import unicodedata
from html.entities import html5

from gleaner.functions.dialect import SPACE, SPACES, SPARK, Dialect, Steps


def _decomposed(c: str) -> str:
    """What compatibility decomposition leaves of a character without its combining marks."""
    return "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))


#: Characters below U+3000 and full-width ones that decompose to a single other one, what it is, and the combining marks.
_CHANGED = [c for i in (*range(0x80, 0x3000), *range(0xFF01, 0xFF5F)) if len(_decomposed(c := chr(i))) == 1 and _decomposed(c) != c]
_MARKS = "".join(c for i in range(0x300, 0x3000) if unicodedata.combining(c := chr(i)))
_FROM, _TO = "".join(_CHANGED) + _MARKS, "".join(map(_decomposed, _CHANGED))
#: Those that decompose to several and occur in texts.
_SEVERAL = {c: _decomposed(c) for c in "…ﬀﬁﬂﬃﬄĳĲ½¼¾№℃™"}
NULLISH = ["", "nan", "none", "null", "n/a"]


def strip_accents(d: Dialect, x: str) -> str:
    """Compatibility decomposition without combining marks. The oracle's own function decomposes canonically alone, so it gets the rest by name."""
    if not d.spark:
        return f"strip_accents(replace(replace({x}, '²', '2'), chr(160), ' '))"
    single = f"translate({x}, {d.lit(_FROM)}, {d.lit(_TO)})"
    several = single
    for c, plain in _SEVERAL.items():
        several = f"replace({several}, {d.lit(c)}, {d.lit(plain)})"
    # looking for a character costs far less than replacing it
    some = " or ".join(f"contains({x}, {d.lit(c)})" for c in _SEVERAL)
    return f"case when octet_length({x}) = char_length({x}) then {x} when {some} then {several} else {single} end"


def normalize(d: Dialect, x: str) -> str:
    """Without accents, white space collapsed, in lower case."""
    return f"lower({d.collapse(strip_accents(d, x))})"


def normalize_steps(d: Dialect, name: str, x: str) -> Steps:
    """``normalize`` as steps: in Spark each part is a column, so that it is tested for what it holds before a pattern is tried."""
    if not d.spark:
        return [(name, normalize(d, x))]
    given, plain = f"{name}_given", f"{name}_plain"
    # white space that has no decomposition is all that is left of it beyond ASCII; control characters and double spaces are rare
    wide = " or ".join(f"contains({plain}, {d.lit(c)})" for c in SPACES if ord(c) > 127 and c not in _FROM)
    odd = f"contains({plain}, '  ') or {d.has(plain, '[' + chr(92) + 'x00-' + chr(92) + 'x1f]')}"
    folded = f"case when {odd} or (octet_length({plain}) > char_length({plain}) and ({wide})) then {d.collapse(plain)} else trim({plain}) end"
    return [(given, x), (plain, strip_accents(d, given)), (name, f"lower({folded})")]


def digits_only(d: Dialect, x: str) -> str:
    return d.sub(x, "[^0-9]+")


def clean(d: Dialect, x: str) -> str:
    """Stripped; spelled-out nulls and nulls become empty."""
    s = d.strip(f"coalesce({x}, '')")
    return f"case when {d.among(f'lower({s})', NULLISH)} then '' else {s} end"


def price_steps(d: Dialect, raw: str, out: str) -> Steps:
    """The first amount in ``raw`` as digits; empty if there is none, it is 0, too long, or several amounts run together.

    Runs of digits are several amounts unless one to three digits are followed by groups of three.
    """
    runs, digits, captured = f"_{out}_runs", f"_{out}_digits", f"_{out}_raw"
    rhythm = r"^[0-9]{1,3}(,[0-9]{3})*$"
    return [
        (captured, d.ext(f"coalesce({raw}, '')", f"[0-9][0-9{SPACE}.,]*")),
        (digits, digits_only(d, captured)),
        (runs, d.join(",", d.every(captured, "[0-9]+"))),
        (
            out,
            f"case when {d.among(digits, ['', '0', '00', '000'])} or length({digits}) > 9 then '' "
            f"when length({digits}) > 7 and contains({runs}, ',') and not {d.has(runs, rhythm)} then '' else {digits} end",
        ),
    ]


def content_steps(d: Dialect, location: str, kind: str, surface: str, price: str, out: str = "content") -> Steps:
    """Digest of what a listing says, over the parts that aren't empty; empty if none is."""
    names = [f"_{out}{k}" for k in range(4)]
    parts = [s for n, x in zip(names, (location, kind, surface)) for s in normalize_steps(d, n, f"coalesce({x}, '')")] + [(names[3], d.strip(f"coalesce({price}, '')"))]
    joined = f"concat_ws('|', {', '.join(f'nullif({n}, {chr(39) * 2})' for n in names)})"
    return [*parts, (f"_{out}", joined), (out, f"case when _{out} = '' then '' else sha1(_{out}) end")]


def escape_cell(d: Dialect, x: str) -> str:
    """Text for a cell of a Markdown table."""
    escaped = f"replace(coalesce({x}, ''), '|', {d.lit(chr(92) + '|')})"
    return d.strip(d.sub(escaped, "[ \t\r\n]+", " "))


def percent(d: Dialect, part: str, total: str) -> str:
    """One decimal, halves to even as the binary value has it; 0.0% of nothing."""
    value = f"cast({part} as double) / {total} * 100"
    shown = f"format_string('%.1f%%', bround({value}, 1))" if d.spark else f"printf('%.1f%%', {value})"
    return f"case when {total} <= 0 then '0.0%' else {shown} end"


def decode_steps(x: str, out: str) -> Steps:
    """Spark: text of an element's inner source: CDATA sections as they stand, character references decoded, no white space at the ends.

    Decimal, hexadecimal and all named references count, and as HTML has it those of the older names without a
    semicolon too. Numbers that name no character give U+FFFD, those from 128 to 159 the characters of windows-1252.
    """
    d, named = SPARK, sorted(k for k in html5 if k.endswith(";"))
    older = "|".join(sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k)))
    unit = chr(0x1F)
    table = f"map_from_arrays(split({d.lit(unit.join(named))}, {d.lit(unit)}), split({d.lit(unit.join(html5[k] for k in named))}, {d.lit(unit)}))"
    c1 = [(chr(b), bytes([b]).decode("cp1252", "replace")) for b in range(0x80, 0xA0)]
    c1 = [(a, b) for a, b in c1 if b != "\ufffd"]
    digits = "case when r.ref rlike '^#[xX]' then conv(regexp_extract(r.ref, '^#[xX]0*([0-9a-fA-F]+)', 1), 16, 10) else regexp_extract(r.ref, '^#0*([0-9]+)', 1) end"
    number = f"coalesce(try_cast({digits} as bigint), 1114112)"
    char = f"translate(decode(unhex(lpad(hex(n), 8, '0')), 'UTF-32'), {d.lit(''.join(a for a, _ in c1))}, {d.lit(''.join(b for _, b in c1))})"
    # an array of one number binds it for the test and the character
    numeric = f"transform(array({number}), n -> case when n = 0 or n > 1114111 or n between 55296 and 57343 then {d.lit(chr(0xFFFD))} else {char} end)[0]"
    bare = f"case when r.old <> '' then concat(try_element_at({table}, concat(r.old, ';')), substring(r.rest, length(r.old) + 1)) else concat('&', r.rest) end"
    name = f"case r.ref when 'amp;' then '&' when 'lt;' then '<' when 'gt;' then '>' when 'quot;' then '\"' when 'apos;' then {d.lit(chr(39))} else try_element_at({table}, r.ref) end"
    refs = f"transform(slice(split({x}, '&'), 2, 1000000000), p -> struct(p as rest, regexp_extract(p, '^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[0-9A-Za-z]+;)', 0) as ref, regexp_extract(p, {d.lit(f'^({older})')}, 0) as old))"
    decoded = f"transform({refs}, r -> case when r.ref like '#%' then concat({numeric}, substring(r.rest, length(r.ref) + 1)) else coalesce(concat({name}, substring(r.rest, length(r.ref) + 1)), {bare}) end)"
    plain = f"case when contains({x}, '&') then concat(substring_index({x}, '&', 1), array_join({decoded}, '')) else {x} end"
    sections = d.sub(x, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1")
    return [(out, d.strip(f"(case when contains({x}, '<![CDATA[') then {sections} else {plain} end)"))]
