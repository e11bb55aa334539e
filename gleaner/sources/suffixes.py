"""Registrable domains by the public suffix list, as built-in expressions.

The list's public part is package data (``public_suffixes.dat``, Mozilla Public
License 2.0, as published, without its private part). Its rules become ``IN`` lists over the last one to
four labels of a host, which the optimizer turns into hash sets, so a host is
resolved in place: no Python worker, no join, no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from functools import lru_cache
from importlib.resources import files
from pathlib import Path

from pyspark.sql import DataFrame

from gleaner.functions.dialect import SPARK, Steps, apply


@lru_cache(4)
def public_suffixes(path: str = "") -> frozenset[str]:
    """Rules of a public suffix list without its private part; by default of the one in this package. Rules in other scripts count in both spellings."""
    file = Path(path) if path else files("gleaner.sources") / "public_suffixes.dat"
    lines = file.read_text(encoding="utf-8").split("===BEGIN PRIVATE DOMAINS===")[0].splitlines()
    rules = {x.strip() for x in lines if x.strip() and not x.startswith("//")}
    return frozenset(rules | {_ascii(x) for x in rules if not x.isascii()})


def _ascii(rule: str) -> str:
    return ".".join(x if x.isascii() else "xn--" + x.encode("punycode").decode() for x in rule.split("."))


@lru_cache(4)
def _lists(path: str) -> dict[tuple[str, int], str]:
    """SQL lists of the plain rules, the parents of wildcards, and the exceptions, by their number of labels."""
    by = defaultdict(list)
    for rule in sorted(public_suffixes(path)):
        kind, name = {"*": ("*", rule[2:]), "!": ("!", rule[1:])}.get(rule[0], ("", rule))
        by[kind, name.count(".") + 1].append(SPARK.lit(name))
    return {k: f"({', '.join(names)})" for k, names in by.items()}


def domain_steps(host: str, out: str = "domain", path: str = "") -> Steps:
    """The label before a host's longest public suffix, with the suffix; the host itself where there is none. Null gives an empty text.

    User, port and dots at the end are left out of account. An exception rule's name
    is registrable itself; a wildcard takes one label more.
    """
    lists = _lists(path)
    longest = max(n + (kind == "*") for kind, n in lists)
    n, tail = f"{out}_n", lambda k: f"{out}_{k}"
    name = f"{out}_name"
    cases = []
    for k in range(longest, 0, -1):
        if ("!", k) in lists:
            cases.append(f"when {tail(k)} in {lists['!', k]} then {tail(k)}")
        rules = [f"{tail(k)} in {lists['', k]}"] if ("", k) in lists else []
        rules += [f"({n} >= {k} and {tail(k - 1)} in {lists['*', k - 1]})"] if ("*", k - 1) in lists else []
        if rules:
            cases.append(f"when {' or '.join(rules)} then case when {n} > {k} then {tail(k + 1)} else {host} end")
    return [
        (name, f"lower(trim(trailing '.' from substring_index(substring_index({host}, '@', -1), ':', 1)))"),
        (n, f"length({name}) - length(replace({name}, '.', '')) + 1"),
        *[(tail(k), f"substring_index({name}, '.', -{k})") for k in range(1, longest + 2)],
        (out, f"coalesce(case {' '.join(cases)} else {host} end, '')"),
    ]


def with_domain(rows: DataFrame, host: str = "u_host", out: str = "domain", path: str = "") -> DataFrame:
    """Adds the registrable domain of a host column."""
    steps = domain_steps(host, out, path)
    return apply(rows, steps).drop(*[name for name, _ in steps[:-1]])
