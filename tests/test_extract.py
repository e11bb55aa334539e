import time

import pytest

from gleaner.html import parse
from gleaner.operators import extract as ex

FULL = """<html><head><title>Maison 4 pièces</title><script type="application/ld+json">{"@type": "Product", "sku": "VP12345", "offers": {"price": "450000"},
"address": {"addressLocality": "Bordeaux", "postalCode": "33000"}, "geo": {"latitude": 44.84, "longitude": -0.58}, "telephone": "+33 5 56 44 06 07",}</script></head>
<body><h1>Maison</h1><ul><li>Surface : 120,5 m²<li>Pièces : 4<li>DPE : C</ul><p>Chambres : 3</p><a href="mailto:contact@agency.fr">mail</a>
<div class="agent-card"><span class="agent-name">Marie Dupont</span></div></body></html>"""


def page(body="", url="https://agency.example/page", head="", job=None):
    return ex.Page(url, f"<html><head>{head}</head><body>{body}</body></html>", job or {})


def test_full_page():
    r = ex.resolve(ex.Page("https://agency.example/vente/x", FULL))
    assert (r["reference_id"], r["price"], r["property_type"], r["surface_area"], r["rooms"], r["dpe_rating"]) == ("VP12345", "450000", "maison", "120.5", "4", "C")
    assert (r["location"], r["coordinates"], r["phone_number"], r["email"], r["agent_name"]) == ("Bordeaux 33000", "44.84, -0.58", "0556440607", "contact@agency.fr", "Marie Dupont")


@pytest.mark.parametrize(
    ("field", "made", "value"),
    [
        ("price", page('<div><span class="price">621 000 €</span></div>'), "621000"),
        ("price", page("Prix : 170 000 €"), "170000"),
        ("price", page("Prix au m² : 3 500 €/m²"), ""),
        ("price", page('<span class="price">Prix sur demande</span>'), ""),
        ("surface_area", page("90,76 m²"), "90.76"),
        ("surface_area", page("1.302 m²"), "1302"),
        ("rooms", page("40 pièces"), ""),
        ("rooms", page(head="<title>Villa T5</title>"), "5"),
        ("bedrooms", page(head="<title>T4</title>"), "3"),
        ("reference_id", page("Réf.: ABC987"), "ABC987"),
        ("reference_id", page(url="https://a.fr/biens/appartement-t3-paris-75011,VA47923"), "VA47923"),
        ("reference_id", page(), ""),
        ("location", page(url="https://a.fr/vente/maison-bordeaux-33000-x"), "Bordeaux 33000"),
        ("location", page('<ul class="breadcrumb"><li>Accueil</li><li>Vente</li><li>Lyon 69001</li></ul>'), "Lyon 69001"),
        ("location", page(head="<title>75011 Paris - Appartement</title>"), "Paris 75011"),
        ("location", page("Agence située Lege Cap Ferret 33950"), "Lege Cap Ferret 33950"),
        ("coordinates", page("<script>var m = {lat: 44.84, lng: -0.58}</script>"), "44.84, -0.58"),
        ("coordinates", page('<iframe src="https://www.google.com/maps?q=43.7,7.27"></iframe>'), "43.7, 7.27"),
        ("phone_number", page('<a href="tel:+33123456789">x</a>'), "0123456789"),
        ("phone_number", page(job={"phone": "+33240853232"}), "0240853232"),
        ("email", page("logo@x320.png"), ""),
        ("email", page("name (AT) site (DOT) fr"), "name@site.fr"),
        ("email", page('<a href="mailto:&#97;@b.fr?subject=x">m</a>'), "a@b.fr"),
        ("dpe_rating", page('<div class="dpe-badge"><span>B</span></div>'), "B"),
        ("dpe_rating", page("Classe énergie : D"), "D"),
        ("agent_name", page(), ""),
        ("agent_name", page(url="https://a.fr/bien/12345", job={"agent_name": "patrimoine rh"}), "Patrimoine Rh"),
    ],
)
def test_fields(field, made, value):
    assert ex.resolve(made)[field] == value


def test_cloudflare():
    key, address = 0x42, b"contact@agence.fr"
    payload = bytes([key, *(b ^ key for b in address)]).hex()
    assert ex.decode_cfemail(payload) == address.decode() and ex.decode_cfemail("zz") == "" and ex.decode_cfemail("") == ""


def test_long_texts_are_quick():
    words = " ".join(f"Mot{chr(97 + i % 26)}" for i in range(240))
    began = time.time()
    ex.resolve(page(words, head=f"<title>{words}</title>"))
    ex.resolve(page("Un Texte " * 120_000))
    assert time.time() - began < 12


def test_tree():
    root = parse('<ul><li class="a B">one<li>two</ul><p>x<div id="d">y</div><img alt=z><br>')
    assert [n.text() for n in root.select("li")] == ["one", "two"] and root.first("div").parent.tag == "#root"
    assert len(root.select("ul .a, #d, [class*='b' i], img[alt='z']")) == 3


def test_listings(spark):
    df = spark.createDataFrame([("https://www.agency.example.fr/vente/x/", FULL, "agency.fr", "Agence"), ("https://b.fr/contact", FULL, "b.fr", None), ("https://c.fr/x", None, None, None)], "url string, html string, domain string, agency_name string")
    rows = ex.extract_listings(df).collect()
    assert [(r.source_url, r.source_domain, r.agency_name) for r in rows] == [("https://agency.example.fr/vente/x", "example.fr", "Agence")]


def test_engine(spark, tmp_path):
    from gleaner.engine import Engine

    names = "seq long, company_name string, contact_person_last_name string, phone_1 string, postalcode string, city string, website string"
    agencies = spark.createDataFrame([(0, "A", "", "", "", "", "agency.fr"), (1, "B", "", "", "", "", ""), (2, "C", "", "", "", "", "gone.fr")], names)
    home = '<html><body><main><a href="/vente/maison-bordeaux-33000-ref-VP12345">x</a><a href="/contact">c</a></main></body></html>'
    pages = spark.createDataFrame([("https://www.agency.fr/", home, 200), ("https://agency.fr/vente/maison-bordeaux-33000-ref-VP12345", FULL, 200)], "url string, html string, status int")
    engine = Engine(spark)
    out = engine.run(agencies, pages)
    assert {(r.domain, r.reason) for r in out.errors.collect()} == {("b", "no_website"), ("gone.fr", "site_not_reachable")}
    text = engine.write(out, str(tmp_path / "out"))
    assert "Total listings written: `1`" in text and "| agency.fr | 1 |" in text
    lines = [r.value for f in sorted((tmp_path / "out" / "report").glob("part*")) for r in spark.read.text(str(f)).collect()]
    assert lines[0] == "# Listing Report" and lines[-2:] == ["| b | failed | no_website |", "| gone.fr | failed | site_not_reachable |"]


def test_engine_logs_a_reason_once_and_takes_own_parts(spark, tmp_path):
    from gleaner.config import EngineConfig
    from gleaner.engine import Engine

    names = "seq long, company_name string, contact_person_last_name string, phone_1 string, postalcode string, city string, website string"
    agencies = spark.createDataFrame([(k, "", "", "", "", "", w) for k, w in enumerate(["", "null", "", "one.co.uk", "two.co.uk"])], names)
    home = '<html><body><main class="ours"><a href="/vente/maison-bordeaux-33000-ref-VP12345">x</a><a href="/item/xyzzy1234">y</a></main></body></html>'
    pages = [(f"https://{d}.co.uk/", home, 200) for d in ("one", "two")] + [("https://two.co.uk/vente/maison-bordeaux-33000-ref-VP12345", FULL.replace('"geo": {"latitude": 44.84, "longitude": -0.58}, ', ""), 200)]

    def nine(page):
        yield "9"

    engine = Engine(spark, EngineConfig(error_log_name="log"), resolvers={"rooms": nine}, families=[("ours", [], ["class=.ours"], ["/item/"], [])])
    out = engine.run(agencies, spark.createDataFrame(pages, "url string, html string, status int"))
    assert sorted((r.domain, r.reason) for r in out.errors.collect()) == [("one.co.uk", "no_listings_found"), ("unknown agency", "no_website")]
    assert [(r.source_domain, r.rooms, r.coordinates) for r in out.listings.collect()] == [("two.co.uk", "9", "")]
    folder = str(tmp_path / "out")
    engine.write(out, folder)
    assert spark.read.option("header", True).csv(f"{folder}/log").count() == 2
    engine.fill_written(folder, spark.createDataFrame([("bordeaux 33000", "1.0, 2.0")], "key string, value string"))
    assert [r.coordinates for r in spark.read.option("header", True).csv(f"{folder}/listings_consolidated").collect()] == ["1.0, 2.0"]


def test_runs_over_arriving_files(spark, tmp_path):
    from gleaner.engine import Engine

    home = '<html><body><main><a href="/vente/maison-bordeaux-33000-ref-VP12345">x</a></main></body></html>'
    pages = spark.createDataFrame([(f"https://{d}.fr{p}", h, 200) for d in "ab" for p, h in (("/", home), ("/vente/maison-bordeaux-33000-ref-VP12345", FULL))], "url string, html string, status int")
    (tmp_path / "in").mkdir()
    head = "company_name,contact_person_last_name,siren,siret,phone_1,postalcode,street,city,website\n"
    for k, sites in enumerate((["a.fr"], ["a.fr", "b.fr"])):
        (tmp_path / "in" / f"{k}.csv").write_text(head + "".join(f"A,,,,,,,,{s}\n" for s in sites))
        Engine(spark).stream(str(tmp_path / "in"), pages, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        rows = spark.read.option("header", True).option("recursiveFileLookup", True).csv(str(tmp_path / "out" / "listings_consolidated")).collect()
        assert sorted(r.source_domain for r in rows) == ["a.fr", "b.fr"][: k + 1]
    # the second batch again, as after a crash before its commit
    for name in ("1", ".1.crc"):
        (tmp_path / "state" / "commits" / name).unlink()
    Engine(spark).stream(str(tmp_path / "in"), pages, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert Engine(spark)._read(str(tmp_path / "out"), "listings_consolidated", ["price"]).count() == 2
