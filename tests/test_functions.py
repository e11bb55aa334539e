import html

import pytest

from gleaner.functions import text, url
from gleaner.functions.dialect import SPARK, apply
from gleaner.operators import classify, extract, resolve
from gleaner.sources.suffixes import public_suffixes, with_domain


def run(spark, rows, schema, steps, out):
    return [r[0] for r in apply(spark.createDataFrame(rows, schema), steps).select(out).collect()]


def test_urls(spark):
    rows = [("HTTPS://www.EX.COM/page/#section",), (" example.com",), ("NaN",), ("https://h/a;p?q=1",), ("https://Ex.com/fr/PATH/",), (None,)]
    steps = url.url_steps(SPARK, "url")
    assert run(spark, rows, "url string", steps, "u_canonical") == ["https://ex.com/page", "https://example.com/", "", "https://h/a;p?q=1", "https://ex.com/fr/PATH", ""]
    assert run(spark, rows, "url string", steps, "u_key")[4] == "https://ex.com/path"


def plain_domain(host: str, rules: frozenset[str]) -> str:
    """The longest rule by hand, label by label."""
    labels = host.split("@")[-1].split(":")[0].rstrip(".").lower().split(".")
    for i in range(len(labels)):
        name = ".".join(labels[i:])
        if "!" + name in rules:
            return name
        if name in rules or "*." + ".".join(labels[i + 1 :]) in rules:
            return ".".join(labels[i - 1 :]) if i else host
    return host


def test_registrable(spark):
    """Every rule of the list, bare and under one and two labels, against a plain search; known cases by hand."""
    rules = public_suffixes()
    names = [r.lstrip("!").replace("*", "any") for r in sorted(rules)]
    hosts = [p + n for n in names for p in ("", "a.", "b.a.")] + ["localhost", "", None, "1.2.3.4", "u@A.Co.UK.:80", "x..com", "example.com:8080"]
    rows = with_domain(spark.createDataFrame([(h, "kept") for h in hosts], "u_host string, domain_n string"), out="d")
    got = {r.u_host: r.d for r in rows.collect()}
    assert rows.columns == ["u_host", "domain_n", "d"] and got == {h: plain_domain(h, rules) if h else "" for h in hosts}
    cases = {"www.foo.bar.example.co.uk": "example.co.uk", "localhost": "localhost", "site.github.io": "github.io", "www.ck": "www.ck", "a.b.c.ck": "b.c.ck", "x.y.city.kawasaki.jp": "city.kawasaki.jp", "m.xn--fiqs8s": "m.xn--fiqs8s", "a.b.xn--55qx5d.cn": "b.xn--55qx5d.cn", "k.公司.cn": "k.公司.cn"}
    assert {r.u_host: r.domain for r in with_domain(spark.createDataFrame([(h,) for h in cases], "u_host string")).collect()} == cases


def test_another_suffix_list(spark, tmp_path):
    (tmp_path / "list").write_text("// one\ncom\n*.zz\n// ===BEGIN PRIVATE DOMAINS===\nfoo.com\n")
    rows = spark.createDataFrame([("a.b.foo.com",), ("a.b.c.zz",), ("a.fr",)], "u_host string")
    assert [r.domain for r in with_domain(rows, path=str(tmp_path / "list")).collect()] == ["foo.com", "b.c.zz", "a.fr"]


def test_character_references(spark):
    """As the standard library's decoder has it; CDATA sections stand as they are."""
    raw = ["a&amp;b", "&#38;x&#x26;", "&apos;&eacute;&nbsp;z", "&copy=1&copyx", "&#0;&#xD800;&#1114112;&#128;&#x9f;&#129;", "plain", " &bogus; & &&amp;amp; ", "&notit;", "&#99999999999999999999;", "&NotEqualTilde;", "", None]
    want = [x and html.unescape(x).strip() for x in raw]
    assert run(spark, [(x,) for x in raw], "x string", text.decode_steps("x", "y"), "y") == want
    assert run(spark, [("<![CDATA[ a&amp;b ]]>",)], "x string", text.decode_steps("x", "y"), "y") == ["a&amp;b"]


@pytest.mark.parametrize(("raw", "amount"), [("621 000 \xa0€", "621000"), ("170,000 € (Fixe)", "170000"), ("€ 89.000", "89000"), ("200200", "200200"), ("0", ""), ("00", ""), ("abc", ""), ("450000.0", "4500000"), ("450000.00", "")])
def test_prices(spark, raw, amount):
    from gleaner.operators.extract import clean_price

    assert clean_price(raw) == amount
    assert run(spark, [(raw,)], "raw string", text.price_steps(SPARK, "raw", "p"), "p") == [amount]


def test_normalize_and_percent(spark):
    assert run(spark, [("  ChÂTEAU \xa0 m²",)], "x string", [("y", text.normalize(SPARK, "x"))], "y") == ["chateau m2"]
    folded = [("Cha\u0302teau",), ("Szőlő ŁÓDŹ",), ("Ｆｕｌｌ ﬁn… №",), ("ñandú ĳ",)]
    want = [extract.fold(x) for x, in folded]
    assert run(spark, folded, "x string", [("y", text.normalize(SPARK, "x"))], "y") == want == ["chateau", "szolo łodz", "full fin... no", "nandu ij"]
    assert run(spark, [(1, 16), (0, 0)], "a long, b long", [("y", text.percent(SPARK, "a", "b"))], "y") == ["6.2%", "0.0%"]


def test_classifier(spark):
    host = "https://agency.example"
    urls = ["/img.jpg", "/recherche", "/annonces", "/biens/vente/maison", "/vente/maison-3-pieces-bordeaux-33000-ref-VP12345", "/biens/appartement-t3-paris-75011,VA47923", "/annonce/123456-villa-cannes", "/vente/1"]
    rows = [(host + u,) for u in urls] + [("https://facebook.com/agency",), ("mailto:a@b",), (None,)]
    df = apply(spark.createDataFrame(rows, "url string"), classify.classify_steps(SPARK)).select("score", "reason", "seed_kind").collect()
    assert [r.score > 0 for r in df] == [False] * 4 + [True] * 3 + [False] * 4
    assert [r.reason for r in df][:3] == ["asset_extension", "hub_path", "hub_path"]
    assert df[7].seed_kind == "hub" and df[10].reason == "empty"


def test_status(spark):
    got = run(spark, [(403,), (429,), (500,), (None,), (200,), (301,), (404,)], "s int", [("r", classify.status_reason("s"))], "r")
    assert got == ["blocked_403", "blocked_403", "site_not_reachable", "site_not_reachable", None, None, "site_not_reachable"]


def test_text_resolvers(spark):
    t = "Prix : 170 000 € Surface : 1.302 m² Pièces : 4 ... Réf.: ABC987 DPE : C Tél : +33 4 78 99 33 11 a [at] b [dot] fr"
    df = spark.createDataFrame([(t, "T5 villa", "", "https://a.fr/page")], "text string, title string, h1 string, url string")
    steps = [*resolve.price_steps(SPARK), *resolve.surface_steps(SPARK), *resolve.rooms_steps(SPARK), *resolve.reference_steps(SPARK), *resolve.property_steps(SPARK), *resolve.phone_steps(SPARK), *resolve.dpe_steps(SPARK), *resolve.email_steps(SPARK, "text", "text")]
    r = apply(df, steps).first()
    assert (r.price, r.surface_area, r.rooms, r.bedrooms, r.reference_id, r.property_type, r.dpe_rating, r.email) == ("170000", "1302", "4", "4", "ABC987", "villa", "C", "a@b.fr")
    assert r.phone_number == "0478993311"
