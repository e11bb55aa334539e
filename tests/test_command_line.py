from gleaner import engine


def test_sitemaps_are_handed_on(spark, tmp_path, monkeypatch):
    pages, maps, agencies = (str(tmp_path / n) for n in ("pages", "maps", "agencies.csv"))
    spark.createDataFrame([("u", "h", 200)], "url string, html string, status int").write.parquet(pages)
    spark.createDataFrame([("a.fr", "https://a.fr/sitemap.xml", "<urlset/>")], "domain string, url string, body string").write.parquet(maps)
    seen = []
    monkeypatch.setattr(engine, "read_agencies", lambda *a: None)
    monkeypatch.setattr(engine.Engine, "run", lambda self, agencies, pages, sitemaps=None, **more: seen.append(sitemaps))
    monkeypatch.setattr(engine.Engine, "write", lambda *a: "")
    engine.main([agencies, pages, "out", "--sitemaps", maps])
    engine.main([agencies, pages, "out"])
    assert [r.domain for r in seen[0].collect()] == ["a.fr"] and seen[1] is None
