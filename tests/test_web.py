import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarrylight import cli
from quarrylight.functions import html as H
from quarrylight.operators import semantic, web
from quarrylight.plans import pipeline
from quarrylight.sources import files
from quarrylight.sources.providers import HashEmbedder, MarkingTranslator, ReplayFetcher, Response, StopwordDetector
from quarrylight.streaming.upsert import upsert_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # fetchers of this file go to workers
FILLER = " ".join(f"word{i}" for i in range(90))


def test_html_tree():
    page = "<h2>Our values</h2><p>One<p><b>two</b><!-- three --><img alt='four' title='five'><nav>no</nav><h3>sub</h3>six<h2>Next</h2>seven"
    assert H.page_text("<script>a</script><p>x  y<style>b</style></p><p>z") == "x y z"
    assert H.headings(page)[0] == ("Our values", 2, "Our values One two three four five sub six")
    assert H.page_text(None) == "" and H.headings("") == []


def test_links():
    page = '<a href="/our-values?x=1#y"> Our\n Values</a><a href="our-values">again</a><a href="/contact">c</a><a href="https://other.de/">o</a><a href="/a.pdf">p</a><a href="http://[x">bad</a><a href="">e</a>'
    base = "https://www.example.com/"
    assert [x[1:] for x in H.links(page, base, base, semantic.excluded)] == [("https://www.example.com/our-values", "/our-values", "Our Values")]
    assert [x[1] for x in H.links(page, base, base)] == ["https://www.example.com/our-values", "https://www.example.com/contact", "https://www.example.com/a.pdf"]


def test_pages_are_searched_once_and_in_small_batches(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)
    monkeypatch.setattr(semantic, "excluded", lambda url: seen.add(1))
    rows = [(i, "https://x.de/", '<a href="/v">a  b</a><a href="https://y.de/">c</a>' if i % 5 else None) for i in range(250)]
    found = semantic.page_links(spark.createDataFrame(rows, "page_id int, url string, html string"), "url", "url")
    assert [tuple(r) for r in found.orderBy("page_id").limit(2).collect()] == [(i, "https://x.de/", 0, "/v", "https://x.de/v", "/v", "a b") for i in (1, 2)]
    seen.value = 0
    assert found.select("page_id", "internal_url").toPandas().shape == (200, 2) and seen.value == 200
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "ArrowEvalPython" not in plan


def test_page_texts_and_sections_in_small_batches(spark):
    html = f"<nav>no</nav><h2>Our values</h2><p>integrity and respect, {FILLER}</p>"
    pages = spark.createDataFrame([(1, html, ""), (2, None, "http_error_404"), (3, "<p>x", None)], "page_id int, html string, crawl_error string")
    scored = [F.lit(0.0).alias(c) for c in ("content_positive_score", "content_negative_score", "semantic_margin")]
    texts = semantic.page_texts(pages)
    again = semantic.rescore(texts.select("*", *scored), HashEmbedder())
    found = semantic.page_sections(pages, HashEmbedder())
    scorer = semantic.scorer_for(HashEmbedder())
    assert [r.page_text for r in texts.orderBy("page_id").collect()] == [H.page_text(html), "", "x"]
    assert [tuple(r)[-3:] for r in again.orderBy("page_id").collect()] == [scorer.score_page(H.page_text(html)), (0.0, 0.0, 0.0), scorer.score_page("x")]
    got = [r.asDict() for r in found.drop("html", "crawl_error").orderBy("page_id").collect()]
    assert got == [{"page_id": i} | scorer.best_section(h) for i, h in ((1, html), (2, ""), (3, "<p>x"))] and got[0]["candidate_section_count"] == 1
    for out, n in ((texts, 1), (again, 2), (found, 1)):
        plan = out.filter(F.col(out.columns[-1]).isNotNull())._jdf.queryExecution().executedPlan().toString()
        assert plan.count("BatchEvalPython") == n and "ArrowEvalPython" not in plan


def test_probe_retries_and_reasons():
    class Flaky:
        def __init__(self, *answers):
            self.answers = list(answers)

        def get(self, url):
            a = self.answers.pop(0)
            if isinstance(a, Exception):
                raise a
            return Response(url, *a)

    from quarrylight.sources.providers import FetchError

    waits = []
    assert web.probe(["u"], Flaky((503, "text/html"), FetchError("Timeout"), (200, "text/html; x")), waits.append)[:7:6] == (True, 3)
    assert web.probe(["u"], Flaky(*[(503, "")] * 3), waits.append)[4] == "http_error:503" and waits == [0.25, 0.5] * 2
    assert web.probe(["u"], Flaky((503, "")), attempts=1)[4::2] == ("http_error:503", 1)
    assert web.probe(["u", "v"], Flaky((404, "a"), (200, "application/pdf")))[4:7:2] == ("non_html:application/pdf", 2)
    assert web.probe(["u"], Flaky(FetchError("TooManyRedirects")))[4] == "too_many_redirects"
    assert web.probe([], Flaky())[4:] == ("invalid", "[]", 0)


def test_robots():
    rules = "User-agent: *\nDisallow: /private\nAllow: /"
    f = ReplayFetcher({"https://example.com/robots.txt": Response("", 200, "text/plain", rules)}, unknown_status=403)
    assert web.robots_verdict("https://example.com/private", f)[2:] == (False, "blocked")
    assert web.robots_verdict("https://example.com/x", f)[2:] == (True, "allowed")
    assert web.robots_verdict("https://other.com/x", f)[2:] == (True, "robots_status_403")


def _site():
    home = f'<a href="/our-values">Our core values</a><p>{FILLER}</p>'
    values = f"<h2>Our values</h2><p>{FILLER}</p>"
    return ReplayFetcher({"https://example.com": Response("https://example.com", 200, "text/html", home), "https://example.com/our-values": Response("https://example.com/our-values", 200, "text/html", values)})


def test_crawl_order_and_budget(spark):
    company = {"company_id": "C1", "homepage_fetch_url": "https://example.com/", "robots_url": "https://example.com/robots.txt"}
    rows = list(web.crawl_site(company, _site(), semantic.scorer_for(HashEmbedder())))
    assert [(r["url"], r["depth"], r["links_queued"]) for r in rows] == [("https://example.com", 0, 1), ("https://example.com/our-values", 1, 0)]
    assert rows[1]["candidate_section_count"] == 1
    df = spark.createDataFrame([company])
    assert [r.url for r in web.crawl(df, _site(), HashEmbedder()).collect()] == [r["url"] for r in rows]

    class Endless:
        def get(self, url):
            links = "".join(f'<a href="{url}/our-values-{i}">our core values</a>' for i in range(9))
            return Response(url, 200, "text/html", f"{links}<p>{FILLER}</p>") if "robots" not in url else Response(url, 404)

    many = list(web.crawl_site(company, Endless(), semantic.scorer_for(HashEmbedder())))
    assert len(many) == 12 and max(r["depth"] for r in many) == 3 and all(r["links_queued"] in (0, 2) for r in many)


def test_stored_crawl_equals_the_crawl_of_each_site(spark):
    def page(links, head="x"):
        return "".join(f'<a href="{x}">our core values</a>' for x in links) + f"<h2>Our values</h2><p>{head} {FILLER}</p>"

    pages, own = [], []
    for n, host in enumerate(("a.com", "b.com", "c.com", "d.com")):
        home = f"https://{host}"
        own.append((f"C{n}", f"{home}/", f"{home}/robots.txt", host if n else None))
        tree = [home] + [f"{home}/our-values-{i}" for i in range(60)]
        pages += [(f"C{n}", u + ("/?q=1" if i % 2 else ""), page([f"{home}/our-values-{(2 * i + k) % 60}" for k in range(3)], u)) for i, u in enumerate(tree)]
        pages.append((f"C{n}", f"{home}/robots.txt", "User-agent: *\nDisallow: /our-values-1\n" if n == 1 else ""))
    pages += [("C0", "https://a.com", ""), ("C0", None, "x"), (None, "https://a.com", "zzz"), ("C2", "https://c.com/our-values-3", None)]
    own += [("C9", "https://nowhere.com", None, "n"), (None, "https://a.com", None, "n")]
    companies = spark.createDataFrame([*own, own[0]], "company_id string, homepage_fetch_url string, robots_url string, name string")
    stored = spark.createDataFrame(pages, "company_id string, url string, html string")
    scorer, wanted = semantic.scorer_for(HashEmbedder()), []
    for company, home, robots, name in own:
        mine = sorted((H.clean_url(u), h or "") for c, u, h in pages if c == company and c is not None and u)
        fetcher = ReplayFetcher({u: Response(u, 200, "text/html", h) for u, h in mine})
        wanted += list(web.crawl_site({"company_id": company, "homepage_fetch_url": home, "robots_url": robots, "name": name}, fetcher, scorer))
    got = [r.asDict() for r in web.crawl_corpus(companies, stored, HashEmbedder()).collect()]
    key = lambda r: (r["company_id"] or "", r["url"])
    assert sorted(got, key=key) == sorted(wanted, key=key) and len(got) > 30
    assert {r["crawl_error"] for r in got} >= {"", "robots_blocked", "http_error_404"}
    assert web.crawl_corpus(companies.limit(0), stored, HashEmbedder()).count() == 0
    plan = web.crawl_corpus(companies, stored, HashEmbedder())._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan


def test_robots_fixture(spark):
    df = spark.createDataFrame([("C1", "x.fr", "https://x.fr/a")], "company_id string, domain string, final_url string")
    assert web.check_robots(df, fixture="Disallow: /x").first()[3:] == ("https://x.fr/robots.txt", 200, False, "Disallow rule present in robots.txt")
    assert web.check_robots(df, fixture="").first()[5:] == (True, "allowed")
    with pytest.raises(ValueError):
        web.check_robots(df)


def test_rescore(spark):
    text = f"Our core values {FILLER}"
    df = spark.createDataFrame([("a", text, ""), ("b", text, "http_error_404"), ("c", " ", None), ("d", None, ""), ("e", text, None)], "id string, page_text string, crawl_error string")
    old = df.selectExpr("*", "1.5D AS content_positive_score", "CAST(NULL AS DOUBLE) AS content_negative_score", "2.5D AS semantic_margin")
    got = {r.id: r[3:] for r in semantic.rescore(old, HashEmbedder()).collect()}
    assert got["b"] == got["c"] == got["d"] == (1.5, None, 2.5)
    assert got["a"] == got["e"] == pytest.approx(semantic.scorer_for(HashEmbedder()).score_page(text))


def test_onnx_embedder_pools_and_names_its_files(monkeypatch):
    import numpy as np

    from quarrylight.sources import providers

    tokens = np.array([[[3.0, 4.0], [9.0, 9.0]], [[1.0, 1.0], [1.0, 1.0]]])
    out = providers.mean_vectors(tokens, np.array([[1, 0], [0, 0]]))
    assert out.tolist() == [[0.6, 0.8], [0.0, 0.0]]

    class Session:
        def get_inputs(self):
            return [type("I", (), {"name": n}) for n in ("input_ids", "attention_mask")]

        def run(self, _, given):
            assert set(given) == {"input_ids", "attention_mask"}
            return [np.stack([given["input_ids"], given["attention_mask"]], -1).astype(float)]

    class Words:
        def enable_truncation(self, n):
            self.n = n

        def enable_padding(self):
            pass

        def encode_batch(self, texts):
            most = max(min(len(t.split()), self.n) for t in texts)
            return [type("C", (), {"ids": [len(w) for w in t.split()][: self.n] + [0] * (most - min(len(t.split()), self.n)), "attention_mask": [1] * min(len(t.split()), self.n) + [0] * (most - min(len(t.split()), self.n)), "type_ids": [0] * most}) for t in texts]

    monkeypatch.setitem(providers._MODELS, ("m", "t"), (Session(), Words()))
    model = providers.OnnxEmbedder("m", "t", max_tokens=3, batch=2)
    got = model.encode(["aa bbbb", "c", "dd dd dd ddddddd"])
    assert got.shape == (3, 2) and np.allclose(np.linalg.norm(got, axis=1), 1)
    assert np.allclose(got[0], np.array([3, 1]) / 10**0.5) and np.allclose(got[2], np.array([2, 1]) / 5**0.5)
    assert len(model.encode([])) == 0
    with pytest.raises(SystemExit):
        cli.main(["--embedder-model", "m", "run-all"])


def test_changed_address_is_probed_again(spark, tmp_path):
    run = pipeline.Run(spark, str(tmp_path / "out"), _World(), HashEmbedder(), StopwordDetector(), MarkingTranslator(), resume=True)
    for rows in ([("C1", "https://a.fr"), ("C2", "https://b.fr")], [("C1", "https://new.fr"), ("C2", "https://b.fr")]):
        run.save("sample", spark.createDataFrame(rows, "company_id string, website_url string"))
        pipeline.availability(run)
    assert sorted((r.company_id, r.final_url) for r in run.load("availability").collect()) == [("C1", "https://new.fr/"), ("C2", "https://b.fr/")]


def test_section_gates():
    assert semantic.passes(True, 0.5, 0.45, 0.1) and not semantic.passes(False, 0.5, 0.45, 0.1) and semantic.passes(False, 0.7, 0.42, 0.07)
    scorer = semantic.scorer_for(HashEmbedder())
    assert scorer.combine([])["candidate_section_count"] == 0 and scorer.score_page("") == (None, None, None)


class _World:
    """Answers for every host: a home page with a values page below it."""

    def get(self, url):
        if url.endswith("/robots.txt"):
            return Response(url, 404)
        if url.rstrip("/").endswith("our-values"):
            return Response(url, 200, "text/html", f"<h2>Our values</h2><p>Our own core values, beliefs and principles: integrity, respect, trust. {FILLER}</p>")
        return Response(url, 200, "text/html", f'<a href="/our-values">Our core values</a><p>{FILLER}</p>')


def test_run_all_and_resume(spark, tmp_path, capsys):
    raw = tmp_path / "raw.csv"
    raw.write_text("Name,Website,Country,Industry,Founded,Size\nAcme Works,https://acme-works.fr,france,retail,2020,51-200\nNA,x.fr,france,retail,1,51-200\n")
    run = pipeline.Run(spark, str(tmp_path / "out"), _World(), HashEmbedder(), StopwordDetector(), MarkingTranslator())
    said = pipeline.run_all(run, str(raw), True, str(tmp_path / "manifest.json"))
    assert said["stages"]["qualify-domains"]["keep"] == 1 and said["stages"]["crawl-websites"]["rows"] == 2
    assert json.loads((tmp_path / "manifest.json").read_text())["seed"] == 42
    run.resume = True
    assert pipeline.crawl(run) == {"rows": 2, "companies": 1}
    assert cli.main(["select-values"], run) == 0 and "rows" in capsys.readouterr().out
    assert cli.main([]) == 0
    with pytest.raises(FileNotFoundError):
        pipeline.prepare(run, str(tmp_path / "none.csv"))


def test_page_folder_and_vectors(spark, tmp_path):
    (tmp_path / "C1.html").write_text("<p>one\ntwo</p>")
    (tmp_path / "C2.htm").write_text("")
    got = {r.company_id: r.html for r in files.read_pages(spark, str(tmp_path)).collect()}
    assert got["C1"] == "<p>one\ntwo</p>" and got.get("C2", "") == ""
    rows = semantic.embed(spark.createDataFrame([("our values",), (None,)], "t string"), "t", HashEmbedder()).collect()
    assert [round(sum(x * x for x in r.vector), 5) for r in rows] == [1, 0]


def test_plain_variants(spark):
    from pyspark.sql import functions as F

    from quarrylight.functions import urls

    df = spark.createDataFrame([("www.a.com/x?q=1",), ("http://b.com",), (None,)], "w string")
    assert [r[0] for r in df.select(urls.url_variants_plain(F.col("w"))).collect()] == [["https://www.a.com/x", "https://a.com/x"], ["http://b.com", "http://www.b.com"], []]


def test_chat_translator_asks_the_fixed_prompt(monkeypatch):
    from quarrylight import catalogue
    from quarrylight.sources import providers

    asked = []

    def get(self, url):
        asked.append((url, json.loads(self.body)))
        return Response(url, 200, "application/json", json.dumps({"message": {"content": "hello"}}))

    monkeypatch.setattr(providers.HttpFetcher, "get", get)
    assert providers.ChatTranslator("http://x").translate("100 % Hund", "de", "German") == "hello"
    assert asked[0][0] == "http://x/api/chat" and asked[0][1]["messages"][0]["content"] == catalogue.TRANSLATION_PROMPT % ("German", "de", "100 % Hund")


def test_csv_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "é")], "id int, t string")
    files.export_csv(df, str(tmp_path / "x.csv"))
    assert (tmp_path / "x.csv").read_bytes().startswith(b"\xef\xbb\xbfid,t")
    for v in ("a", "b"):
        spark.createDataFrame([(1, v), (2, v)] if v == "a" else [(2, v)], "id int, v string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id int, v string").parquet(str(tmp_path / "in"))
        upsert_stream(stream, str(tmp_path / "table"), "id", str(tmp_path / "checkpoint")).awaitTermination()
    assert sorted((r.id, r.v) for r in spark.read.parquet(str(tmp_path / "table")).collect()) == [(1, "a"), (2, "b")]
