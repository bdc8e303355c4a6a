import random

import pytest
from pyspark.sql import functions as F

from quarrylight import catalogue as C
from quarrylight.functions import match, text, urls
from quarrylight.operators import companies, resume
from quarrylight.sources import files

RAW = "NAME string, WEBSITE string, COUNTRY string, INDUSTRY string, FOUNDED int, SIZE string"


def test_clean_keeps_contract_columns_and_small_companies(spark):
    rows = [("Acme Group", "https://acmegroup.fr", "France ", "retail", 2020, "51-200"), ("Solo Shop", "soloshop.com", "france", "unknown industry", 2020, "11-50"), ("Outlier", "example.org", "france", "retail", 2020, "1-10"), (None, "x.com", "france", "retail", 1, "51-200")]
    raw = spark.createDataFrame(rows, RAW)
    out = companies.clean(raw)
    assert out.columns == ["name", "country", "industry", "size", "size_bucket", "High_Level_Sector", "website_url", "domain"]
    assert {(r.name, r.size_bucket, r.High_Level_Sector, r.domain) for r in out.collect()} == {("acme group", "small", "Consumer Goods & Retail", "acmegroup.fr"), ("solo shop", "small", "Other", "soloshop.com")}
    assert companies.prepare_summary(raw).first().asDict() == {"input_rows": 4, "written_rows": 2, "unmapped_rows": 1}


def test_clean_names_missing_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns.*website"):
        companies.clean(spark.createDataFrame([("a",)], "name string"))


@pytest.mark.parametrize("site,usable", [("acme.fr", True), ("a@b.fr", False), ("acme", False), ("http://x.fr/a.PDF", False), ("https://www.facebook.com/acme", False), ("m.facebook.com", False), ("notfacebook.com", True), ("  ", False), (None, False)])
def test_website_usable(spark, site, usable):
    assert spark.createDataFrame([(site,)], "w string").select(urls.website_usable(F.col("w"))).first()[0] is usable


def test_url_functions(spark):
    rows = ["HTTP://x.de", "http://www.Ex_ample.com:80/a b?q#f", "shop.de/", "http://a.b.com.au/x.html/", ""]
    out = spark.createDataFrame([(r,) for r in rows], "u string").select(urls.domain_of(F.col("u")), urls.clean_internal_url(F.col("u")), urls.normalised_path(F.col("u")), F.to_json(urls.url_variants(F.col("u")))).collect()
    assert out[1][0] == "ex_ample.com:80" and out[1][1] == "http://www.Ex_ample.com:80/a b"
    assert out[2][0] == "shop.de" and out[3][1] == "http://a.b.com.au/x.html" and out[3][2] == "/x.html"
    assert out[4][0] is None and out[4][3] == "[]"
    assert out[2][3] == '["https://shop.de/","https://www.shop.de/"]'


@pytest.mark.parametrize("domain,suffix,label", [("a.com.au", "com.au", "a"), ("x.shop.co.jp", "co.jp", "shop"), ("com.au", "au", "com"), ("localhost", "", "localhost"), ("10.0.0.1", "", "1"), ("acme-group.fr:80", "fr", "acme-group")])
def test_public_suffix(spark, domain, suffix, label):
    assert tuple(spark.createDataFrame([(domain,)], "d string").select(urls.public_suffix(F.col("d")), urls.registered_label(F.col("d"))).first()) == (suffix, label)


def test_qualification(spark):
    rows = [("Acme Corporation", "france", "acme.fr"), ("Another Company", "france", "shared.example.com"), ("Shared Company", "france", "shared.example.com"), ("Unrelated Company", "france", "example.org"), ("Acme", "france", "acme.de"), ("No Site", "france", None), ("Nor This", "france", None)]
    df = spark.createDataFrame(rows, "name string, country string, domain string")
    got = {r.name: r.qualification_status for r in companies.qualify(df).collect()}
    assert got == {"Acme Corporation": "keep", "Another Company": "review", "Shared Company": "review", "Unrelated Company": "remove", "Acme": "review", "No Site": "remove", "Nor This": "remove"}
    assert {r.name for r in companies.qualify(df, share_null_domain=True).filter("qualification_status = 'review'").collect()} >= {"No Site", "Nor This"}
    assert companies.qualify(df.limit(0)).count() == 0


@pytest.mark.parametrize("name,label,scores", [("Bright Idea Partners", "bip", (0, 0, 60)), ("Bright Idea Partners", "bipgroup", (0, 0, 40)), ("Acme Group", "acmegroup", (0, 35, 0)), ("Solo Shop", "soloshop", (0, 70, 0)), ("Acme Works", "acme-works", (100, 0, 0)), ("Äcme GmbH", "acme", (80, 0, 0))])
def test_match_score(spark, name, label, scores):
    df = spark.createDataFrame([(name, label)], "n string, l string").select(text.company_tokens(text.ascii_fold(F.col("n"))).alias("c"), text.label_tokens(F.col("l")).alias("d"))
    m = df.select(match.match_score(F.col("c"), F.col("d")).alias("m")).first().m
    assert (m.exact_score, m.substring_score, m.abbreviation_score) == scores


def _pool(spark, n=600):
    rnd = random.Random(1)
    sectors = ["Retail", "Energy", "Legal", C.GOVERNMENT_SECTOR, "Media", "Food", "Travel"]
    rows = [(f"c{i}", rnd.choice(["france", "japan"]), rnd.choice([*C.KNOWN_SIZES, "odd"]), rnd.choices(sectors, [9, 3, 1, 4, 1, 1, 1])[0]) for i in range(n)]
    return spark.createDataFrame([*rows, ("z", "chad", "odd", "Retail")], "name string, country string, size_bucket string, High_Level_Sector string")


def test_sample_fills_sizes_and_repeats(spark):
    pool = _pool(spark)
    first, second = companies.sample(pool).collect(), companies.sample(pool.repartition(7)).collect()
    assert first == second
    counts = {}
    for r in first:
        counts[(r.country, r.size_bucket)] = counts.get((r.country, r.size_bucket), 0) + 1
    assert all(counts[(c, s)] == 25 for c in ("france", "japan") for s in C.KNOWN_SIZES)
    assert counts[("chad", "odd")] == 1 and ("france", "odd") not in counts
    ids = [r.company_id for r in companies.with_ids(companies.sample(pool)).orderBy("company_id").collect()]
    assert ids[0] == "C0001" and len(set(ids)) == len(first)


def test_sample_sizes_can_be_set(spark):
    pool = _pool(spark)
    few = companies.sample(pool, per_size={"small": 3, "large": 2}, per_sector=1).collect()
    assert {(c, s): sum(r.country == c and r.size_bucket == s for r in few) for c in ("france", "japan") for s in C.KNOWN_SIZES} == {(c, s): n for c in ("france", "japan") for s, n in zip(C.KNOWN_SIZES, (3, 0, 2, 0), strict=True)}
    assert len({r.High_Level_Sector for r in few if r.country == "france" and r.size_bucket == "small"}) == 3
    capped = companies.sample(pool, per_country=7).collect()
    assert [sum(r.country == c for r in capped) for c in ("france", "japan")] == [7, 7]
    with pytest.raises(ValueError):
        companies.sample(pool, per_size=-1)


def test_numbered_equals_one_window(spark):
    pool = _pool(spark).unionAll(spark.createDataFrame([("n", None, "odd", "Retail"), ("m", "japan", None, None)], "name string, country string, size_bucket string, High_Level_Sector string"))
    ready = pool.selectExpr("*", "concat('https://', name) AS final_url")
    wanted = {r.name: r.company_id for r in companies.with_ids(ready).collect()}
    assert {r.name: r.company_id for r in companies.scrape_ready(ready).collect()} == wanted and len(wanted) == 603


def _turns(rows, per_country, per_sector, most):
    """Queue by queue, as the sampler is defined."""
    queues, out, sectors = {}, [], {}
    for r in sorted(rows, key=lambda r: (r["size_bucket"], r["High_Level_Sector"], r["order"])):
        queues.setdefault((r["size_bucket"], r["High_Level_Sector"]), []).append(r)
    while len(out) < per_country and any(queues.values()):
        for key in sorted(queues):
            if len(out) >= per_country or not queues[key]:
                continue
            r = queues[key].pop(0)
            s = r["High_Level_Sector"]
            if sectors.get(s, 0) < (min(most, per_sector) if s == C.GOVERNMENT_SECTOR else per_sector):
                sectors[s] = sectors.get(s, 0) + 1
                out.append(r["name"])
    return set(out)


def test_round_robin_equals_queues(spark):
    pool = _pool(spark)
    order = companies._draw(F.col("name"), 42, "queue")
    rows = [r.asDict() for r in pool.withColumn("order", order).collect()]
    for per_country, per_sector in ((12, 5), (60, 5), (25, 3)):
        got = companies.round_robin(pool, per_country, per_sector).collect()
        for country in ("france", "japan", "chad"):
            assert {r.name for r in got if r.country == country} == _turns([r for r in rows if r["country"] == country], per_country, per_sector, int(per_country * 0.1))


def test_government_share(spark):
    df = spark.createDataFrame([("a", "france", C.GOVERNMENT_SECTOR), ("b", "france", "Retail")], "name string, country string, High_Level_Sector string")
    with pytest.raises(AssertionError):
        companies.check_government(df)
    with pytest.raises(ValueError):
        companies.check_government(df.limit(0))
    companies.check_government(df.filter("name = 'b'"))


def test_split_input_and_checked_merge(spark):
    checked = spark.createDataFrame([("a", True), ("b", False), ("c", None)], "company_id string, is_website_reachable boolean")
    reached, missed = companies.reachable_split(checked)
    assert [r.company_id for r in reached.collect()] == ["a"] and [r.company_id for r in missed.collect()] == ["b"]
    rows = spark.createDataFrame([("1", "n", "c", "s", "d", "u2", 0), ("1", "n", "c", "s", "d", "u1", 0), ("2", "n", "c", "s", "d", None, 0), (None, "n", "c", "s", "d", "u", 0), ("3", "n", "c", "s", "d", "u", 0)], "company_id string, name string, country string, size_bucket string, domain string, final_url string, extra int")
    out = companies.crawl_input(rows)
    assert sorted((r.company_id, r.final_url) for r in out.collect()) == [("1", "u1"), ("3", "u")] and "extra" not in out.columns
    assert companies.crawl_input(rows, run_size=1).count() == 1
    with pytest.raises(ValueError):
        companies.crawl_input(rows, run_size=0)
    left, right = spark.createDataFrame([(1, "x"), (1, "y")], "k int, l string"), spark.createDataFrame([(1, "r")], "k int, r string")
    assert resume.merge_checked(left, right, "k", "many_to_one").count() == 2
    for a, b, kind in ((left, right, "one_to_one"), (right, left, "many_to_one")):
        with pytest.raises(ValueError):
            resume.merge_checked(a, b, "k", kind)


def test_a_table_survives_a_cut_write(spark, tmp_path):
    path = f"{tmp_path}/t"
    files.write_table(spark.range(3).toDF("i"), path)
    again = files.write_table(files.read_table(spark, path).filter("i > 0"), path)
    assert again.count() == 2 and not files.exists(spark, f"{path}.old")
    (tmp_path / "t").rename(tmp_path / "t.old")  # cut between the two renames
    assert files.read_table(spark, path).count() == 2
    assert files.write_table(files.read_table(spark, path).filter("i > 1"), path).count() == 1 and files.read_table(spark, path).count() == 1
