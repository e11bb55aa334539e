"""Cheaper forms of the listing steps say the same as the patterns that they stand for."""

import random
import re

from pyspark.sql import functions as F

from gleaner import vocabulary as v
from gleaner.functions import text as tx
from gleaner.functions.dialect import SPACES, SPARK, apply
from gleaner.operators import classify as cl, resolve as rs

RNG = random.Random(3)


def _mixed(parts: list[str], n: int = 400) -> list[tuple[str]]:
    return [("".join(RNG.choice(parts) for _ in range(RNG.randrange(12))),) for _ in range(n)]


def test_normalizing_by_steps(spark):
    rows = spark.createDataFrame([*_mixed([*SPACES, "é", "²", "…", "½", "€", "A", "b", "  ", "\x01"]), (None,)], "text string")
    got = apply(rows, tx.normalize_steps(SPARK, "n", "text")).withColumn("want", F.expr(tx.normalize(SPARK, "text"))).where("not (n <=> want)")
    assert got.collect() == []


def test_empty_numbers_are_not_cast(spark):
    assert [r[0] for r in spark.createDataFrame([("",), ("12",), (" 3 ",), ("x",), (None,)], "x string").select(F.expr(SPARK.int("x"))).collect()] == [None, 12, 3, None, None]
    assert "<> ''" in SPARK.int("x")


def test_patterns_with_heads_match_as_before(spark):
    parts = ["3", "12", " ", "pièces", "PIECE", "room", "chambres", "Bedroom", ":", "T4", "Prix", "price : 9 €/m²", "sur demande", "nous consulter", "-ref-12345", "/annonce", "-vp123", "id=999", "dpe", " A ", "classe energie B"]
    rows = spark.createDataFrame(_mixed(parts), "x string")
    for pattern, heads in [(v.ROOMS, "pr0-9"), (v.BEDROOMS, "cb0-9"), (v.T_ROOMS, "t"), (v.PRICE_LABEL, "p"), (v.ON_REQUEST, "sopn"), (v.PER_AREA, "€epc"), (v.REFERENCE_HINT, "ri/\\-"), *zip(v.DPE_LABELS, ("d", "d", "ce", "c"))]:
        assert rows.where(f"{SPARK.ext('x', pattern)} <> {SPARK.ext('x', SPARK.begun(pattern, heads))}").count() == 0, pattern


def test_addresses_near_the_first_bracket(spark):
    texts = _mixed(["agence", "x" * 70, ".", " ", "  ", "[at]", "( AT )", "[dot]", "(dot)", "fr", "(", "]", "é", "a@b.fr"], 1500)
    texts += [("a [at] b [dot] fr",), ("x" * 64 + " [at] b [dot] fr (x)",), ("x" * 80 + "\n[at] b [dot] fr",), ("(75) me [at] b [dot] com",)]
    got = apply(spark.createDataFrame(texts, "text string"), rs.email_steps(SPARK, "text", "text")[:4]).select("text", "em_spelled0").collect()
    for text, found in got:
        # possessive runs, as the operator has them
        want = [f"{a}@{b}.{c}".lower() for a, b, c in re.findall(v.OBFUSCATED.replace("{1,64})", "{1,64}+)"), text, re.ASCII)] if re.search(v.OBFUSCATED_MARK, text, re.ASCII) else []
        want = [w for w in want if not any(x in w for x in v.EMAIL_REJECTS)]
        assert found == (want[0] if want else ""), text
    assert any(r[1] for r in got)


def test_words_stand_before_hub_and_family_patterns():
    urls = [u for (u,) in _mixed(["/annonces", "/", "listing-vente.html", "vente-immobilier", "prix-m2", "/search", "/result", "/produits/all", "x", "/properties", "page=", "zipcode=", "piece"])]
    assert all(any(w in u for w in v.HUB_WORDS) for u in urls if re.search(v.HUB_PATTERN, u))
    assert all(any(w in u for w in v.QUERY_WORDS) == bool(re.search(v.QUERY_HINT, u)) for u in urls)
    assert cl._begin(["ab?c"]) == ["a"] and cl._begin(["[ab]c"]) is None and cl._begin(["a|b"]) is None and cl._begin(["abc?"]) == ["ab"] and cl._begin(["\\bOrpi\\b"]) == ["orpi"]
    for name, hosts, markers, _, _ in v.FAMILIES:
        assert cl._begin(markers), name
