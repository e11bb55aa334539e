"""Row-wise operators as steps of SQL expressions, for Spark and for an oracle engine.

A step names a new column and gives its expression over the columns before it.
Steps keep each expression small, so nothing is parsed or planned twice, and
Catalyst sees plain built-in functions throughout. The same steps can be
rendered for DuckDB, whose results the tests and the driver compare.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

#: Unicode white space, as Python's ``\\s`` has it, for inside a character class.
SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

SPACES = "".join(c for i in range(0x3001) if (c := chr(i)).isspace())
_OTHER = r"\t\n\f\r" + SPACE.removeprefix(r"\s")



def any_of(words) -> str:
    """A pattern that any of the words matches: those that hold another one are left out, the others share their beginnings."""
    words = set(words)
    tree: dict = {}
    for w in sorted(w for w in words if not any(x != w and x in w for x in words)):
        node = tree
        for c in w:
            node = node.setdefault(c, {})

    def pattern(node: dict) -> str:
        # no word holds another, so none ends where a longer one goes on
        parts = [re.escape(c) + pattern(below) for c, below in node.items()]
        return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})" if parts else ""

    return pattern(tree)


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def lit(self, s: str) -> str:
        return "'" + (s.replace("\\", "\\\\").replace("'", "\\'") if self.spark else s.replace("'", "''")) + "'"

    def has(self, x: str, pattern: str) -> str:
        return f"({x} rlike {self.lit(pattern)})" if self.spark else f"regexp_matches({x}, {self.lit(pattern)})"

    def ext(self, x: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({x}, {self.lit(pattern)}, {group})"

    def every(self, x: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract_all({x}, {self.lit(pattern)}, {group})"

    def begun(self, pattern: str, heads: str) -> str:
        """The same pattern, which in Spark is tried only at the characters (without regard to case) that all of its matches begin with."""
        # single characters are looked up in one table, a range is another test of each
        return f"(?i)(?=[{heads.replace('0-9', '0123456789')}])(?:{pattern.removeprefix('(?i)')})" if self.spark else pattern

    def sub(self, x: str, pattern: str, by: str = "") -> str:
        """``by`` refers to groups as $1."""
        return f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(by)})" if self.spark else f"regexp_replace({x}, {self.lit(pattern)}, {self.lit(by.replace('$', chr(92)))}, 'g')"

    def within(self, x: str, words) -> str:
        """Whether any of the words occurs in x; many words are one pattern, so that generated code stays small."""
        words = list(words)
        if len(words) > 12:
            return self.has(x, any_of(words) if self.spark else "|".join(re.escape(w) for w in words))
        return "(" + " or ".join(f"contains({x}, {self.lit(w)})" for w in words) + ")"

    def among(self, x: str, words) -> str:
        return f"({x} in ({', '.join(self.lit(w) for w in words)}))"

    def split(self, x: str, sep: str) -> str:
        return f"split({x}, {self.lit(sep)})" if self.spark else f"string_split({x}, {self.lit(sep)})"

    def where(self, array: str, test) -> str:
        """Elements of an array for which ``test(name)`` holds."""
        return f"filter({array}, s -> {test('s')})" if self.spark else f"list_filter({array}, lambda s: {test('s')})"

    def each(self, array: str, make) -> str:
        return f"transform({array}, s -> {make('s')})" if self.spark else f"list_transform({array}, lambda s: {make('s')})"

    def count(self, array: str) -> str:
        return f"size({array})" if self.spark else f"len({array})"

    def last(self, array: str) -> str:
        return f"coalesce(try_element_at({array}, -1), '')" if self.spark else f"coalesce(list_extract({array}, -1), '')"

    def first(self, array: str) -> str:
        return f"coalesce(try_element_at({array}, 1), '')" if self.spark else f"coalesce(list_extract({array}, 1), '')"

    def join(self, sep: str, array: str) -> str:
        return f"array_join({array}, {self.lit(sep)})" if self.spark else f"array_to_string({array}, {self.lit(sep)})"

    def array(self, items) -> str:
        return f"array({', '.join(items)})" if self.spark else f"[{', '.join(items)}]"

    def collapse(self, x: str) -> str:
        """Runs of white space to a space, none at either end. Single spaces, which are most of them, aren't matched."""
        return f"trim({self.sub(x, f'[{_OTHER}][{SPACE}]*| [{SPACE}]+', ' ')})"

    def strip(self, x: str, chars: str = SPACES, side: str = "both") -> str:
        """Without the characters (white space) at the ends; ``side`` may be leading or trailing."""
        if self.spark:
            return f"trim({side} {self.lit(chars)} from {x})"
        return f"{ {'both': 'trim', 'leading': 'ltrim', 'trailing': 'rtrim'}[side]}({x}, {self.lit(chars)})"

    def before(self, x: str, sep: str) -> str:
        """What comes before the first separator; all of it without one."""
        return f"substring_index({x}, {self.lit(sep)}, 1)" if self.spark else f"split_part({x}, {self.lit(sep)}, 1)"

    def after_last(self, x: str, sep: str) -> str:
        return f"substring_index({x}, {self.lit(sep)}, -1)" if self.spark else f"split_part({x}, {self.lit(sep)}, -1)"

    def int(self, x: str) -> str:
        # a failed cast is an exception in Spark, so the text that fails most isn't cast
        return f"case when {x} <> '' then try_cast({x} as bigint) end" if self.spark else f"try_cast({x} as bigint)"


SPARK, DUCKDB = Dialect("spark"), Dialect("duckdb")
Steps = list[tuple[str, str]]


def apply(df: DataFrame, steps: Steps) -> DataFrame:
    """Adds the steps' columns, in as few projections as their longest chain has steps: each copies all columns of every row.

    A step goes beside all others that are as far from the given columns, wherever they stand in
    the list; one that replaces a column waits for those before it.
    """
    levels: list[dict[str, str]] = []
    at: dict[str, int] = {}
    given = set(df.columns)

    def flush(df: DataFrame) -> DataFrame:
        for level in levels:
            df = df.withColumns({n: F.expr(e) for n, e in level.items()})
        return df

    for name, expression in steps:
        if name in at or name in given:
            df, levels, at, given = flush(df), [], {}, set(df.columns) - {name}
        at[name] = 1 + max((at[w] for w in set(re.findall(r"\w+", expression)) if w in at), default=-1)
        levels += [{}] * (at[name] == len(levels))
        levels[at[name]][name] = expression
    return flush(df)


def render(source: str, steps: Steps, columns: list[str]) -> str:
    """DuckDB SQL of the steps over a table or a query in parentheses."""
    for name, expression in steps:
        source = f"(select *, {expression} as {name} from {source})"
    return f"select {', '.join(columns)} from {source}"


def keep(df: DataFrame, condition: str) -> DataFrame:
    """Rows that meet a condition over columns made by steps.

    A plain filter would be pushed down through all the steps' projections and
    take the whole chain of expressions along, each inlined wherever it is used.
    A row number beside the columns holds the filter above them.
    """
    return df.withColumn("_row", F.monotonically_increasing_id()).where(f"({condition}) and _row >= 0").drop("_row")
