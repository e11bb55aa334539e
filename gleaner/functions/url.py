"""URL functions as expressions and steps. URLs are split leniently, by a pattern, never by a strict parser."""

from __future__ import annotations

from gleaner.functions.dialect import Dialect, Steps

LANGUAGES = ["en", "fr", "de", "es", "it"]


def ensure_scheme(d: Dialect, x: str) -> str:
    """A URL with its scheme in lower case, https where it has none; empty for spelled-out nulls. ``x`` is stripped already."""
    n = f"case lower(substring({x}, 1, 8)) when 'https://' then 5 else case lower(substring({x}, 1, 7)) when 'http://' then 4 else 0 end end"
    return f"case when {d.among(f'lower({x})', ['', 'nan', 'none', 'null'])} then '' when {n} > 0 then concat(lower(substring({x}, 1, {n})), substring({x}, {n} + 1)) else concat('https://', {d.strip(x, '/', 'leading')}) end"


def url_steps(d: Dialect, url: str, prefix: str = "u_") -> Steps:
    """Parts of a URL: scheme, netloc, host (without www.), path, params, query; then canonical, key and the classifier's path.

    Cuts at single characters, which cost far less than patterns.
    """
    p = lambda name: prefix + name
    language = f"^([a-z]+://[^/]*)/({'|'.join(LANGUAGES)})/"
    after = lambda x, head, n: f"substring({x}, length({head}) + {n + 1})"
    return [
        (p("raw"), d.strip(f"coalesce({url}, '')")),
        (p("full"), ensure_scheme(d, p("raw"))),
        (p("scheme"), d.before(p("full"), "://")),
        (p("away"), after(p("full"), p("scheme"), 3)),
        (p("site"), d.before(d.before(d.before(p("away"), "/"), "?"), "#")),
        (p("netloc"), f"lower({p('site')})"),
        (p("host"), f"case when {p('netloc')} like 'www.%' then substring({p('netloc')}, 5) else {p('netloc')} end"),
        (p("whole"), d.before(after(p("away"), p("site"), 0), "#")),
        (p("rest"), d.before(p("whole"), "?")),
        (p("query"), after(p("whole"), p("rest"), 1)),
        (p("last"), d.after_last(p("rest"), "/")),
        (p("params"), after(p("last"), d.before(p("last"), ";"), 1)),
        (p("path"), f"case when {p('params')} <> '' then substring({p('rest')}, 1, length({p('rest')}) - length({p('params')}) - 1) when {p('rest')} = '' then '/' else {p('rest')} end"),
        (p("short"), f"case when {p('path')} = '/' then '/' else {d.strip(p('path'), '/', 'trailing')} end"),
        (p("tail"), f"concat(case when {p('params')} <> '' then concat(';', {p('params')}) else '' end, case when {p('query')} <> '' then concat('?', {p('query')}) else '' end)"),
        (p("canonical"), f"case when {p('full')} = '' then '' else concat({p('scheme')}, '://', {p('host')}, {p('short')}, {p('tail')}) end"),
        (p("key"), d.sub(f"lower({p('canonical')})", language, "$1/")),
        (p("lowpath"), f"lower(case when {p('short')} = '' then '/' else {p('short')} end)"),
        (p("lowfull"), f"case when {p('query')} = '' then {p('lowpath')} else concat({p('lowpath')}, '?', lower({p('query')})) end"),
    ]


def www_variants(d: Dialect, prefix: str = "u_") -> tuple[str, str]:
    """The URL with and without www., after ``url_steps``."""
    rest = f"{prefix}path, {prefix}tail"
    return f"concat({prefix}scheme, '://www.', {prefix}host, {rest})", f"concat({prefix}scheme, '://', {prefix}host, {rest})"


def probe_variants(d: Dialect, prefix: str = "u_") -> str:
    """Https before http, www. before bare."""
    rest = f"{prefix}path, {prefix}tail"
    made = d.array([f"concat('{s}://', '{w}', {prefix}host, {rest})" for s in ("https", "http") for w in ("www.", "")])
    none = "cast(array() as array<string>)" if d.spark else "cast([] as varchar[])"
    return f"case when {prefix}host = '' then {none} else {made} end"


def under_domain(host: str, domain: str) -> str:
    """Whether a host belongs to a registrable domain, for Spark."""
    name = f"regexp_replace(regexp_replace({host}, '^.*@', ''), ':[0-9]*$', '')"
    return f"({domain} <> '' and ({name} = {domain} or endswith({name}, concat('.', {domain}))))"


def bucket(d: Dialect, host: str, n: int) -> str:
    """Stable bucket of a host: the first four bytes of its md5, modulo n."""
    head = f"substring(md5({host}), 1, 8)"
    return f"pmod(cast(conv({head}, 16, 10) as bigint), {n})" if d.spark else f"cast('0x' || {head} as bigint) % {n}"
