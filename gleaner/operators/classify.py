"""Predicates and classifiers over URLs, fetch outcomes and listings, as expression steps."""

from __future__ import annotations

import re
from collections.abc import Callable

from gleaner import vocabulary as v
from gleaner.functions.dialect import Dialect, Steps
from gleaner.functions.url import url_steps


def _asset(d: Dialect, x: str) -> str:
    if d.spark:
        return d.has(x, "\\.(?:" + "|".join(e.removeprefix(".") for e in v.BAD_EXTENSIONS) + ")$")
    return d.has(x, "(" + "|".join(e.replace(".", "\\.") for e in v.BAD_EXTENSIONS) + ")$")


def classify_steps(d: Dialect, url: str = "url") -> Steps:
    """``score`` and ``reason`` of a URL, and ``seed_kind``: detail, hub or reject."""
    full, path = "u_lowfull", "u_lowpath"
    positive = "case " + " ".join(f"when contains({full}, {d.lit(t)}) then {d.lit(t)}" for t in v.POSITIVE_TERMS) + " else '' end"
    if d.spark:  # a short expression, where generated code of many branches would be interpreted
        positive = d.first(d.where(d.array(map(d.lit, v.POSITIVE_TERMS)), lambda s: f"contains({full}, {s})"))
    signals = [
        ("c_term <> ''", 2, "c_term"),
        (d.has(full, d.begun(v.REFERENCE_HINT, "ri/\\-")), 8, "'ref'"),
        # the URL is in lower case, where the words say the same as the pattern
        (d.within(full, v.QUERY_WORDS) if d.spark else d.has(full, v.QUERY_HINT), 1, "'query'"),
        (d.has(full, v.T_HINT), 2, "'t-notation'"),
        (f"{d.count('c_segments')} >= 3", 2, "'deep_path'"),
        (d.has("c_last", "[0-9]{4,}"), 2, "'numeric_slug'"),
        (d.among("c_last", v.BARE_TAILS), -8, "'hub_tail'"),
    ]
    flags: Steps = [(f"c_on{k}", test) for k, (test, _, _) in enumerate(signals)]
    total = " + ".join(f"case when c_on{k} then {points} else 0 end" for k, (_, points, _) in enumerate(signals))
    bits = ", ".join(f"case when c_on{k} then {name} end" for k, (_, _, name) in enumerate(signals))
    lower: Steps = [("c_url", f"lower({url})")] if d.spark else []
    small = "c_url" if d.spark else f"lower({url})"
    seed = f"{d.has(url, '^https?://')} and not {_asset(d, small)} and not {d.within(small, v.SOCIAL_HOSTS)} and not {d.within(small, v.SEED_REJECTS)}"
    hub = f"({d.within(full, v.HUB_WORDS)} and {d.has(full, v.HUB_PATTERN)})" if d.spark else d.has(full, v.HUB_PATTERN)
    return [
        *url_steps(d, url),
        *lower,
        ("c_low", f"lower({d.strip(url)})"),
        ("c_bare", d.sub(path, "/+$")),
        ("c_segments", d.where(d.split(path, "/"), lambda s: f"{s} <> ''")),
        ("c_last", d.last("c_segments")),
        ("c_term", positive),
        *flags,
        ("c_points", total),
        (
            "reason",
            f"case when coalesce({url}, '') = '' then 'empty' when {d.has('c_low', '^(' + '|'.join(v.BAD_SCHEMES) + ')')} then 'bad_scheme' "
            f"when {d.within('c_low', v.SOCIAL_HOSTS)} then 'social' when {_asset(d, 'c_low')} then 'asset_extension' when {path} = '/' then 'root' "
            f"when {d.within(full, v.NON_LISTING_TERMS)} then 'non_listing_term' when {d.among('c_bare', v.HUB_PATHS)} then 'hub_path' "
            f"when {hub} then 'hub_pattern' when {d.has('c_last', v.PAGE_TAIL)} and not {d.has('c_bare', v.REFERENCE_TAIL)} then 'pagination_index' "
            f"when c_points <= 0 and {d.count('c_segments')} <= 2 then 'shallow_no_signal' else coalesce(nullif(concat_ws(',', {bits}), ''), 'none') end",
        ),
        (
            "score",
            "case reason when 'empty' then 0 when 'bad_scheme' then -100 when 'social' then -50 when 'asset_extension' then -50 when 'root' then 0 when 'non_listing_term' then -20 "
            "when 'hub_path' then -10 when 'hub_pattern' then -10 when 'pagination_index' then -10 when 'shallow_no_signal' then -1 else c_points end",
        ),
        ("is_seed", f"coalesce({seed}, false)"),
        ("seed_kind", f"case when not is_seed then 'reject' when score > 0 then 'detail' when {d.among('reason', v.HUB_REASONS)} then 'hub' else 'reject' end"),
    ]


def _begin(patterns: list[str]) -> list[str] | None:
    """The plain words that the patterns begin with, of which every match holds one, in lower case; None if a pattern begins with none."""
    found = [re.match(r"(?:\\b|\\\.|/)*([A-Za-z0-9-]{2,})(?![A-Za-z0-9-])", p) for p in patterns]
    if any(m is None or "|" in re.sub(r"\([^()]*\)", "", p) for m, p in zip(found, patterns, strict=True)):
        return None
    # a sign after the word may make its last letter optional
    return sorted({m[1].lower()[: -1 if p[m.end() : m.end() + 1] in ("?", "*", "{") else None] for m, p in zip(found, patterns, strict=True)})


def family_steps(d: Dialect, host: str, html: str, url: str, known: list | None = None) -> Steps:
    """``families`` of a site by host or markers, comma-joined in their order, and ``boost`` of a URL from them. ``known`` replaces the families of the vocabulary."""
    steps, boost = [("f_host", f"lower({host})"), ("f_html", f"lower({html})")] if d.spark else [], []
    known = v.FAMILIES if known is None else known

    def any_has(x: str, small: str, patterns: list[str]) -> str:
        test = d.has(x, "(?i)(" + "|".join(patterns) + ")")
        words = _begin(patterns) if d.spark else None
        return f"({d.within(small, words)} and {test})" if words else test

    for name, hosts, markers, urls, _ in known:
        tests = ([any_has(host, "f_host", hosts)] if hosts else []) + [any_has(html, "f_html", markers)]
        steps.append((f"f_{name}", f"({' or '.join(tests)})"))
        boost.append(f"case when f_{name} and {d.has(url, '(?i)(' + '|'.join(urls) + ')')} then {v.FAMILY_BOOST} else 0 end")
    names = ", ".join(f"case when f_{f[0]} then '{f[0]}' end" for f in known)
    return [*steps, ("families", f"concat_ws(',', {names})"), ("boost", " + ".join(boost))]


def dynamic_steps(d: Dialect, html: str) -> Steps:
    """``looks_dynamic``: whether a page's head needs a browser. No family needs one."""
    head = f"substring(coalesce({html}, ''), 1, {v.HEAD_CHARS})"
    return [
        ("d_head", head),
        ("d_text", d.strip(d.sub(d.ext("d_head", v.BODY, 1), "<[^>]+>", " "))),
        ("looks_dynamic", f"case when d_head = '' or {d.has('d_head', v.STRONG_DYNAMIC)} then true else {d.has('d_head', v.WEAK_DYNAMIC)} and not {d.has('d_head', v.STRUCTURE)} and length(d_text) < {v.LEAST_TEXT} end"),
    ]


def status_reason(status: str) -> str:
    """Canonical reason of an HTTP status; null where it is fine."""
    return f"case when {status} is null then 'site_not_reachable' when {status} in (401, 403, 429) then 'blocked_403' when {status} >= 200 and {status} < 400 then cast(null as string) else 'site_not_reachable' end"


def exception_reason(d: Dialect, name: str, message: str) -> str:
    n, m = f"lower(coalesce({name}, ''))", f"lower(coalesce({message}, ''))"
    return f"case when {d.within(n, v.NETWORK_NAMES)} or {d.within(m, v.NETWORK_MESSAGES)} then 'site_not_reachable' when {d.within(m, v.SCRIPT_MESSAGES)} then 'dynamic_js_required' else 'parsing_failed' end"


def usable_response(d: Dialect, status: str, content_type: str, text: str) -> str:
    """Whether a fetch went well and its body is HTML-like and not empty."""
    kind = f"lower({d.strip(f'coalesce({content_type}, {chr(39) * 2})')})"
    denied = d.has(kind, "^(image/|video/|audio/|font/|application/pdf|application/zip|application/octet-stream)")
    like = f"case when {kind} = '' then coalesce({text}, '') <> '' when {denied} then false else contains({kind}, 'html') or contains({kind}, 'xml') or {d.has(kind, '^text/')} end"
    return f"coalesce({status} >= 200 and {status} < 400, false) and ({like}) and coalesce({text}, '') <> ''"


def strategy(reason: str, dynamic: str) -> str:
    return f"case when {reason} = 'blocked_403' then 'dynamic' when {reason} = 'site_not_reachable' then 'none' when {dynamic} then 'dynamic' else 'static' end"


def used_strategy(failure: str, static_found: str, rendered_found: str) -> str:
    """What a domain's listings came from: blocked sites are only rendered, others are rendered where static pages yield nothing."""
    return (
        f"case when {failure} = 'site_not_reachable' then 'none' when {failure} = 'blocked_403' then case when {rendered_found} > 0 then 'dynamic' else 'none' end "
        f"when {static_found} = 0 and {rendered_found} > 0 then 'hybrid' else 'static' end"
    )


def interrupted_reason(d: Dialect, event: str, reachable: str, name: str, message: str) -> str:
    """Why a domain's work ended early: ``event`` is timeout or crash; ``reachable`` whether its host had answered (null: it wasn't asked)."""
    known = f"coalesce({reachable}, false)"
    return (
        f"case {event} when 'timeout' then case when {known} then 'no_listings_found' else 'site_not_reachable' end "
        f"when 'crash' then case when {known} then 'parsing_failed' else {exception_reason(d, name, message)} end end"
    )


def empty_reason(reason: str, suggested: str, renderer: str) -> str:
    """Why a domain has no listings."""
    return f"case when {reason} = 'blocked_403' then 'blocked_403' when {suggested} = 'dynamic' and not {renderer} then 'dynamic_js_required' when {reason} = 'site_not_reachable' then 'site_not_reachable' else 'no_listings_found' end"


def _listing_url(d: Dialect) -> str:
    path = d.sub("lower(coalesce(source_url, ''))", "[?].*$")
    info = d.count(d.where(d.split(path, "/"), lambda s: d.among(s, v.INFO_SEGMENTS)))
    return f"not {d.within(path, v.INFO_COMPOUNDS)} and {info} = 0"


def _enough(d: Dialect, known: list[str]) -> str:
    """Whether the known fields are enough for a listing; a further field that is filled never takes that back."""
    on = {f: f"({d.strip(f'coalesce({f}, {chr(39) * 2})')} <> '')" if f in known else "false" for f in v.INFORMATIVE_FIELDS}
    filled = " + ".join(f"case when {x} then 1 else 0 end" for x in on.values())
    anchor = (
        f"({on['price']} or ({on['reference_id']} and ({on['surface_area']} or {on['rooms']} or {on['property_type']})) "
        f"or ({on['surface_area']} and ({on['rooms']} or {on['location']} or {on['property_type']})))"
    )
    return f"({filled}) >= 2 and {anchor}"


def publishable(d: Dialect) -> str:
    """Whether a row with the listing fields carries enough of a listing."""
    return f"({_listing_url(d)} and {_enough(d, v.INFORMATIVE_FIELDS)})"


def publishable_steps(d: Dialect, known: list[str], tiers: list[tuple[list[str], Callable[..., Steps]]], sources: list[str]) -> Steps:
    """``publishable`` of rows with the fields ``known``: the others are resolved only as far as they decide it.

    A tier names the fields that its steps yield, and is given the columns that stand for
    ``sources``: they are empty in rows that are decided, which leaves its fields empty.
    """
    steps: Steps = [("v_listing", _listing_url(d)), ("v_enough", _enough(d, known))]
    for k, (fields, resolver) in enumerate(tiers):
        known = [*known, *fields]
        held = [f"v_{x}{k}" for x in sources]
        steps += [(h, f"case when v_listing and not v_enough{k or ''} then {x} else '' end") for h, x in zip(held, sources, strict=True)]
        steps += [*resolver(*held), (f"v_enough{k + 1}", f"v_enough{k or ''} or ({_enough(d, known)})")]
    return [*steps, ("publishable", f"v_listing and v_enough{len(tiers) or ''}")]
