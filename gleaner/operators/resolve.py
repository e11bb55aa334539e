"""Field resolvers over text, title and URL, as expression steps.

Each field's tiers are tried in order and the first that yields a value wins.
Tiers that need the page's tree are in ``gleaner.operators.extract``.
"""

from __future__ import annotations

from gleaner import vocabulary as v
from gleaner.functions.dialect import SPACE, Dialect, Steps
from gleaner.functions.text import digits_only, normalize, normalize_steps


def first_filled(*values: str) -> str:
    return "coalesce(" + ", ".join(f"nullif({x}, '')" for x in values) + ", '')"


def unless(filled: str, value: str) -> str:
    """A value that is worked out only where an earlier tier has left the field empty."""
    return f"case when {filled} <> '' then '' else {value} end"


def surface_steps(d: Dialect, text: str = "text") -> Steps:
    steps: Steps = []
    for name, pattern in (("sl", v.SURFACE_LABEL), ("so", v.SURFACE_LOOSE)):
        dotted, dots, raw = f"{name}_dotted", f"{name}_dots", f"replace({d.strip(d.ext(text, pattern, 1), side='trailing')}, ' ', '')"
        steps += [
            (name, raw if name == "sl" else unless("sl_value", raw)),
            (dotted, f"replace(replace({name}, {d.lit(chr(160))}, ''), ',', '.')"),
            (dots, f"length({dotted}) - length(replace({dotted}, '.', ''))"),
            (
                f"{name}_value",
                f"case when {dotted} like '.%' then '' when {dots} > 1 then concat(replace({d.sub(dotted, '[.][^.]*$')}, '.', ''), '.', {d.ext(dotted, '([^.]*)$', 1)}) "
                f"when {dots} = 1 and not contains({name}, ',') and {d.has(dotted, '^[0-9]+[.][0-9]{3}$')} then replace({dotted}, '.', '') else {dotted} end",
            ),
        ]
    return [*steps, ("surface_area", first_filled("sl_value", "so_value"))]


def _bounded(d: Dialect, x: str, low: int, minus: int = 0) -> str:
    n = d.int(x)
    return f"case when {n} between {low} and 30 then cast({n} - {minus} as string) else '' end"


def rooms_steps(d: Dialect, text: str = "text", title: str = "title", h1: str = "h1", url: str = "url") -> Steps:
    hay = f"concat_ws(' ', {title}, {h1}, {url})"
    return [
        # the one number in a match, before or after the word
        ("r_rooms", digits_only(d, d.ext(text, d.begun(v.ROOMS, "pr0-9")))),
        ("r_beds", digits_only(d, d.ext(text, d.begun(v.BEDROOMS, "cb0-9")))),
        ("r_t", d.ext(hay, d.begun(v.T_ROOMS, "t"), 1)),
        ("rooms", first_filled(_bounded(d, "r_rooms", 1), _bounded(d, "r_t", 1))),
        ("bedrooms", first_filled(_bounded(d, "r_beds", 0), _bounded(d, "r_t", 1, 1))),
    ]


def _slug_shaped(d: Dialect, x: str) -> str:
    hyphens = f"length({x}) - length(replace({x}, '-', ''))"
    return f"(length({x}) between 1 and {v.LONGEST_SLUG} and {hyphens} <= {v.MOST_HYPHENS} and not {d.has(x, '^[0-9]+$')} and {d.has(x, '[0-9]|' + v.ACRONYM)})"


def _junk(d: Dialect, x: str) -> str:
    return d.within(f"lower({x})", v.JUNK_TOKENS)


def _identifier(d: Dialect, x: str) -> str:
    return f"(length({x}) >= 3 and {d.has(x, v.IDENTIFIER)})"


def reference_steps(d: Dialect, text: str = "text", url: str = "url") -> Steps:
    trim = lambda x: d.sub(x, "^[.,;:]+|[.,;:]+$")
    steps: Steps = []
    # an earlier tier's value spares the later ones
    late = (lambda filled, x: unless(filled, x)) if d.spark else (lambda filled, x: x)
    for k, pattern in enumerate(v.REFERENCE_LABELS):
        x = f"ref_label{k}"
        raw = trim(d.ext(text, pattern, 1))
        steps += [(f"{x}_raw", late("ref_label0", raw) if k else raw), (x, f"case when not {_junk(d, x + '_raw')} and {_identifier(d, x + '_raw')} and {_slug_shaped(d, x + '_raw')} then {x}_raw else '' end")]
    verb = lambda x: d.among(f"lower({d.ext(x, '^([^-]*)', 1)})", v.UI_VERBS)
    return [
        *steps,
        ("ref_code", late("concat(ref_label0, ref_label1)", d.ext(url, v.REFERENCE_CODE, 1))),
        *[(f"ref_tail{k}", late("concat(ref_label0, ref_label1, ref_code)", d.ext(url, p, 1))) for k, p in enumerate(v.REFERENCE_TAILS)],
        ("ref_last", late("concat(ref_label0, ref_label1, ref_code)", d.ext(d.sub(d.ext(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1), "/+$"), "([^/]*)$", 1))),
        ("ref_stem", trim(d.ext("ref_last", "^(.*),[^,]*$", 1))),
        ("ref_end", trim(d.ext("ref_last", ",([^,]*)$", 1))),
        ("ref_bare", trim("ref_last")),
        ("ref_name", d.sub("ref_bare", "[.][^.]*$")),
        (
            "ref_slug",
            f"case when contains(ref_last, '+') then '' when contains(ref_last, ',') then case when length(ref_end) >= 3 and not {_junk(d, 'ref_stem')} and not {_junk(d, 'ref_end')} "
            f"and not {verb('ref_stem')} and (ref_stem = '' or {_identifier(d, 'ref_stem')}) and {_slug_shaped(d, 'ref_end')} then ref_end else '' end "
            f"when length(ref_bare) >= 3 and not {_junk(d, 'ref_bare')} and not {d.has('ref_name', v.NAV_ROOT)} and not {verb('ref_name')} and {_identifier(d, 'ref_name')} "
            f"and {_slug_shaped(d, 'ref_name')} then ref_bare else '' end",
        ),
        ("reference_id", first_filled("ref_label0", "ref_label1", "ref_code", "ref_tail0", "ref_tail1", "ref_tail2", "ref_slug")),
    ]


def _best_type(d: Dialect, x: str) -> str:
    """Canonical type of the best synonym in x: least rank, then longest, then first."""
    terms = sorted((rank, -len(s), s, name) for name, rank, synonyms in v.PROPERTY_TYPES for s in synonyms)
    if d.spark:  # a list that is gone through: code of as many branches is too long to be compiled
        pairs = d.array(f"named_struct('term', {d.lit(s)}, 'name', {d.lit(name)})" for _, _, s, name in terms)
        return f"case when {x} = '' then '' else coalesce(get(filter({pairs}, s -> contains({x}, s.term)), 0).name, '') end"
    return "case " + " ".join(f"when contains({x}, {d.lit(s)}) then {d.lit(name)}" for _, _, s, name in terms) + " else '' end"


def property_steps(d: Dialect, title: str = "title", h1: str = "h1", url: str = "url") -> Steps:
    path = d.ext(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    # all segments begin as the first pattern has it, which is found sooner than any of them
    some = v.SEGMENT_HEAD if d.spark else "|".join(p for p, _ in v.PROPERTY_SEGMENTS)
    segments = f"case when not {d.has('p_path', some)} then '' " + " ".join(f"when {d.has('p_path', p)} then {d.lit(name)}" for p, name in v.PROPERTY_SEGMENTS) + " else '' end"
    texts = [("p_title", title), ("p_h1", h1), ("p_url", url)]

    def late(name: str, x: str, last: str) -> Steps:
        if d.spark:
            return normalize_steps(d, name, unless(last, f"coalesce({x}, '')"))
        return [(name, unless(last, normalize(d, f"coalesce({x}, '')")))]

    return [
        ("p_path", f"lower({path})"),
        ("p_segment", segments),
        *[step for (name, x), last in zip(texts, ["p_segment", "p_title_best", "p_h1_best"], strict=True) for step in (*late(name, x, last), (name + "_best", f"case when {last} <> '' then {last} else {_best_type(d, name)} end"))],
        ("property_type", "p_url_best"),
    ]


def phone_number(raw: str, digits: str, rest: str) -> str:
    """French numbers in ten digits; empty for what can't be one. ``rest`` are the digits without two leading zeros."""
    plus = f"{raw} like '+33%'"
    nine = lambda x: f"case when length({x}) = 9 then concat('0', {x}) else '' end"
    return (
        f"case when {digits} = '' then '' when {plus} then {nine(f'substring({digits}, 3)')} when {digits} like '0033%' then {nine(f'substring({digits}, 5)')} "
        f"when {digits} like '33%' and length({digits}) = 11 then concat('0', substring({digits}, 3)) when length({rest}) < 8 or length({rest}) > 10 then '' "
        f"when length({rest}) = 9 and {rest} not like '0%' then concat('0', {rest}) else {rest} end"
    )


def phone_steps(d: Dialect, text: str = "text") -> Steps:
    steps: Steps = []
    for k, pattern in enumerate([*v.PHONE_LABELS, v.PHONE_FREE]):
        raw = d.strip(d.ext(text, pattern, 1))
        number = phone_number(f"ph_raw{k}", f"ph_digits{k}", f"ph_rest{k}")
        steps += [
            (f"ph_raw{k}", unless(f"ph{k - 1}", raw) if k else raw),
            (f"ph_digits{k}", digits_only(d, f"ph_raw{k}")),
            (f"ph_rest{k}", f"case when ph_digits{k} like '00%' then substring(ph_digits{k}, 3) else ph_digits{k} end"),
            (f"ph{k}", f"case when ph{k - 1} <> '' then ph{k - 1} else {number} end" if k else number),
        ]
    return [*steps, ("phone_number", f"ph{k}")]


def email_steps(d: Dialect, text: str = "text", html: str = "html") -> Steps:
    """Addresses in the text: spelled out with at and dot, else as they are; the first that is acceptable."""

    def good(x: str) -> str:
        return f"not {d.within(f'lower({x})', v.EMAIL_REJECTS)} and not {d.has(f'lower({x})', '^(noreply|no-reply)@')}"

    # what follows a run can't be in it, so none is given back
    pattern = v.OBFUSCATED.replace("{1,64})", "{1,64}+)") if d.spark else v.OBFUSCATED

    def spelled(x: str) -> str:
        return f"lower({d.sub(x, '^' + pattern + '$', '$1@$2.$3')})"

    steps: Steps = []
    # where both are the same column, the second holds nothing that the first doesn't
    sources = (text,) if d.spark and text == html else (text, html)
    for k, source in enumerate(sources):
        # the mark in brackets is looked for first, as it starts with a rare character
        head = f"em_head{k}"
        steps.append((head, f"substring({source}, 1, {v.OBFUSCATED_CHARS})"))
        if d.spark:
            # nothing before the run that the first bracket follows can be in a match
            steps.append((f"em_before{k}", d.ext(head, r"^[^\[(]*")))
            steps.append((f"em_near{k}", f"substring({head}, char_length(em_before{k}) - char_length({d.ext(f'reverse(em_before{k})', v.OBFUSCATED_RUN)}) + 1)"))
            head = f"em_near{k}"
        found = d.first(d.where(d.each(d.every(head, pattern), spelled), good))
        value = f"case when {d.has(f'em_head{k}', v.OBFUSCATED_MARK)} then {found} else '' end"
        steps.append((f"em_spelled{k}", unless("em_spelled0", value) if k else value))
    spelled_out = [f"em_spelled{k}" for k in range(len(sources))]
    steps.append(("em_head", f"substring({html}, 1, {v.EMAIL_CHARS})"))
    steps.append(("em_plain", f"case when {' or '.join(f"{x} <> ''" for x in spelled_out)} then '' when contains(em_head, '@') then {d.first(d.where(d.every('em_head', v.EMAIL), good))} else '' end"))
    return [*steps, ("email", first_filled(*spelled_out, "em_plain"))]


def dpe_steps(d: Dialect, text: str = "text") -> Steps:
    found = [f"case when {d.within('dpe_text', words)} then {d.ext('dpe_text', d.begun(p, heads), 1)} else '' end" for p, words, heads in zip(v.DPE_LABELS, v.DPE_WORDS, ("d", "d", "ce", "c"), strict=True)]
    return [*normalize_steps(d, "dpe_text", f"coalesce({text}, '')"), ("dpe_rating", "upper(" + first_filled(*found) + ")")]


def _price(d: Dialect, raw: str, digits: str) -> str:
    """Digits of an amount as it was captured; empty if it is no sale price."""
    runs = d.join(",", d.every(raw, "[0-9]+"))
    apart = f"length({digits}) > 7 and contains({runs}, ',') and not {d.has(runs, '^[0-9]{1,3}(,[0-9]{3})*$')}"
    return f"case when length({digits}) between 1 and 9 and not ({apart}) and {d.int(digits)} between {v.LEAST_PRICE} and {v.MOST_PRICE} then {digits} else '' end"


def price_steps(d: Dialect, text: str = "text") -> Steps:
    """The first labelled amount that is a sale price. The label is itself a price label to amounts of few digits only if it recurs in the capture."""

    def good(x: str) -> str:
        small = f"length({x}.price) > {v.SMALL_DIGITS} or {d.has(f'{x}.label', v.CURRENCY_OR_LABEL)}"
        return f"{x}.price <> '' and not {d.has(f'{x}.label', d.begun(v.ON_REQUEST, 'sopn'))} and not {d.has(f'{x}.label', d.begun(v.PER_AREA, '€epc'))} and ({small})"

    def struct(**parts: str) -> str:
        return f"named_struct({', '.join(f'{chr(39)}{n}{chr(39)}, {x}' for n, x in parts.items())})" if d.spark else "{" + ", ".join(f"'{n}': {x}" for n, x in parts.items()) + "}"

    amount = f"[0-9][0-9{SPACE}.,]*"
    return [
        ("pr_labels", d.each(d.every(text, d.begun(v.PRICE_LABEL, "p"), 1), lambda x: struct(label=x, raw=d.ext(x, amount)))),
        ("pr_digits", d.each("pr_labels", lambda x: struct(label=f"{x}.label", raw=f"{x}.raw", digits=digits_only(d, f"{x}.raw")))),
        ("pr_prices", d.each("pr_digits", lambda x: struct(label=f"{x}.label", price=_price(d, f"{x}.raw", f"{x}.digits")))),
        ("price", d.first(d.each(d.where("pr_prices", good), lambda x: f"{x}.price"))),
    ]
