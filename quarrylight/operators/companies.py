"""Companies: cleaning, domain qualification, sampling."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import catalogue as C
from ..functions import match, text, urls
from ..schemas import CLEANED, RAW, require_columns
from .resume import last


def column_names(df: DataFrame) -> DataFrame:
    """Stripped, lower-case names with _ for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def _lookup(pairs: dict[str, str], key: Column, default: str) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in pairs.items() for x in p]), key), F.lit(default))


def size_bucket(size: Column) -> Column:
    return _lookup(C.SIZE_BUCKETS, size, "too_small")


def sector(industry: Column) -> Column:
    return _lookup(C.INDUSTRY_SECTOR, text.clean_text_value(industry), C.OTHER_SECTOR)


def _judged(raw: DataFrame) -> DataFrame:
    """All rows with their cleaned columns and __kept, true for companies that stay."""
    df = column_names(raw)
    missing = sorted(set(RAW) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    df = df.select(*[text.clean_text_value(F.col(c)).alias(c) for c in RAW])
    df = df.withColumns({"website_url": urls.normalise_url(F.col("website")), "domain": urls.domain_of(F.col("website")), "size_bucket": size_bucket(F.col("size")), "High_Level_Sector": sector(F.col("industry"))})
    kept = F.col("country").isin(*C.COUNTRIES) & urls.website_usable(F.col("website")) & F.col("domain").isNotNull() & (F.col("size_bucket") != "too_small")
    for c in RAW:
        kept = F.col(c).isNotNull() & kept
    return df.withColumn("__kept", kept)


def clean(raw: DataFrame) -> DataFrame:
    """Companies of the target countries with a usable site and a known size."""
    return _judged(raw).filter("__kept").select(*CLEANED)


def prepare_summary(raw: DataFrame) -> DataFrame:
    """input_rows, written_rows and unmapped_rows (sector Other), from one scan."""
    other = F.col("High_Level_Sector") == C.OTHER_SECTOR
    return _judged(raw).agg(F.count(F.lit(1)).alias("input_rows"), F.count(F.when(F.col("__kept"), 1)).alias("written_rows"), F.count(F.when(F.col("__kept") & other, 1)).alias("unmapped_rows"))


def score(df: DataFrame, company: str = "name", domain: str = "domain", country: str = "country") -> DataFrame:
    """df with tokens, scores, country_domain_status and qualification_status."""
    require_columns(df, [company, domain, country])
    out = df.withColumns({
        "company_tokens": text.company_tokens(text.ascii_fold(F.col(company))),
        "domain_tokens": F.when(F.col(domain).isNull(), F.array().cast("array<string>")).otherwise(text.label_tokens(text.ascii_fold(urls.registered_label(F.col(domain))))),
    })
    out = out.withColumn("m", match.match_score(F.col("company_tokens"), F.col("domain_tokens"))).select("*", "m.*").drop("m")
    out = out.withColumn("country_domain_status", urls.country_status(F.col(country), F.col(domain)))
    return out.withColumn("qualification_status", match.status(F.col("domain_match_score"), F.col("country_domain_status")))


def sharing(df: DataFrame, company: str = "name") -> DataFrame:
    """df with the number of companies and countries that use its domain.

    Counted by aggregation and joined back, so that a domain shared by very many rows is never gathered in
    one task.
    """
    counts = df.groupBy(F.col("domain").alias("__domain")).agg(F.countDistinct(company).alias("companies_using_domain"), F.countDistinct("country").alias("countries_using_domain"))
    return df.join(counts, F.col("domain").eqNullSafe(F.col("__domain"))).drop("__domain")


def qualify(df: DataFrame, share_null_domain: bool = False) -> DataFrame:
    """Scored companies; domains of several companies are sent to review.

    share_null_domain: also review companies without a domain if there are several.
    """
    out = sharing(score(df), "company_id" if "company_id" in df.columns else "name")
    shared = (F.col("companies_using_domain") > 1) & (F.lit(share_null_domain) | F.col("domain").isNotNull())
    return out.withColumn("qualification_status", F.when(shared, F.lit("review")).otherwise(F.col("qualification_status")))


def status_counts(qualified: DataFrame) -> DataFrame:
    status = F.col("qualification_status")
    return qualified.agg(F.count(F.lit(1)).alias("checked"), *[F.count(F.when(status == s, 1)).alias(s) for s in ("keep", "review", "remove")])


def _draw(key: Column, seed: int, salt: str) -> Column:
    """A random order that every engine can reproduce: md5 of seed, salt and key."""
    return F.md5(F.concat_ws("|", F.lit(f"{seed}|{salt}"), key).cast("binary"))


def sample(df: DataFrame, seed: int = 42, key: str = "name", per_size: int | dict[str, int] = C.PER_SIZE, per_sector: int = C.PER_SECTOR, per_country: int = C.PER_COUNTRY) -> DataFrame:
    """Per country and size up to per_size companies, at most per_sector of a sector first, topped up from the rest.

    per_size is one number, or one for each size (sizes that are not named give none). No country gives more
    than per_country companies; those without any known size give up to as many. The order is a hash, so the
    draw does not depend on partitions. Rows are ordered by country, size, sector and name.
    """
    targets = per_size if isinstance(per_size, dict) else dict.fromkeys(C.KNOWN_SIZES, per_size)
    if not targets or min(*targets.values(), per_sector, per_country) < 0:
        raise ValueError("sample sizes must be there and must not be negative")
    require_columns(df, ["country", "size_bucket", "High_Level_Sector", key])
    df = df.filter(F.col("country").isNotNull())
    known = df.filter(F.col("size_bucket").isin(*C.KNOWN_SIZES) & F.col("High_Level_Sector").isNotNull())
    id_ = F.col(key).cast("string")
    by_sector = Window.partitionBy("country", "size_bucket", "High_Level_Sector").orderBy(_draw(id_, seed, "sector"), key)
    by_size = Window.partitionBy("country", "size_bucket").orderBy(F.col("__s") > per_sector, _draw(id_, seed, "size"), key)
    limit = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in targets.items() for x in p]), F.col("size_bucket")), F.lit(0))
    chosen = known.withColumn("__s", F.row_number().over(by_sector)).withColumn("__n", F.row_number().over(by_size)).filter(F.col("__n") <= limit).drop("__s", "__n")
    without = df.join(known.select("country").distinct(), "country", "left_anti")
    by_country = Window.partitionBy("country").orderBy(_draw(id_, seed, "country"), key)
    first = lambda rows: rows.withColumn("__n", F.row_number().over(by_country)).filter(F.col("__n") <= per_country).drop("__n")
    rest = first(without)
    if sum(targets.values()) > per_country:
        chosen = first(chosen)
    return chosen.unionByName(rest).orderBy("country", "size_bucket", "High_Level_Sector", key)


def with_ids(sampled: DataFrame, key: str = "name") -> DataFrame:
    """company_id C0001, C0002, ... in sample order; a sample has at most 100 rows a country."""
    order = Window.orderBy("country", "size_bucket", "High_Level_Sector", key)
    return sampled.withColumn("company_id", F.format_string("C%04d", F.row_number().over(order)))


def numbered(df: DataFrame, key: str = "name") -> DataFrame:
    """with_ids for tables of any size: rows are numbered within their country, size and sector, after those of the groups before.

    Only the groups' counts are numbered in one task. Equal keys come in the order of their address.
    """
    group = ["country", "size_bucket", "High_Level_Sector"]
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__size"))
    before = counts.withColumn("__before", F.sum("__size").over(Window.orderBy(*group)) - F.col("__size")).select(*[F.col(c).alias(f"__{c}") for c in group], "__before")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group]
    place = F.row_number().over(Window.partitionBy(*group).orderBy(key, "final_url"))
    out = df.withColumn("__place", place).join(before, same[0] & same[1] & same[2])
    return out.withColumn("company_id", F.format_string("C%04d", F.col("__before") + F.col("__place"))).select(*df.columns, "company_id")


def round_robin(df: DataFrame, per_country: int = 60, per_sector: int = 5, government_share: float = 0.10, seed: int = 42, key: str = "name") -> DataFrame:
    """Per country, one company of each (size, sector) queue in turn, under quotas for sectors and government.

    A queue loses its head in every round, taken or not. As a sector's quota can take at most per_country
    rows of a queue in that many rounds, longer queues are first cut to what a country can use.
    """
    require_columns(df, ["country", "size_bucket", "High_Level_Sector", key])
    order = Window.partitionBy("country", "size_bucket", "High_Level_Sector").orderBy(_draw(F.col(key).cast("string"), seed, "queue"), key)
    df = df.filter(F.col("country").isNotNull() & F.col("size_bucket").isNotNull() & F.col("High_Level_Sector").isNotNull())
    # A sector's quota ends within per_sector rounds of taking or never again, so later heads change nothing.
    heads = df.withColumn("__round", F.row_number().over(order)).filter(F.col("__round") <= per_sector)
    most = int(per_country * government_share)

    def turn(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["__round", "size_bucket", "High_Level_Sector"], kind="stable")
        taken, sectors, keep = 0, {}, []
        for name in pdf["High_Level_Sector"]:
            limit = min(per_sector, most) if name == C.GOVERNMENT_SECTOR else per_sector
            ok = taken < per_country and sectors.get(name, 0) < limit
            sectors[name] = sectors.get(name, 0) + ok
            taken += ok
            keep.append(ok)
        return pdf[keep]

    return heads.groupBy("country").applyInPandas(turn, heads.schema).drop("__round")


def government_summary(df: DataFrame) -> DataFrame:
    total, state = F.count("name"), F.count(F.when(F.col("High_Level_Sector") == C.GOVERNMENT_SECTOR, 1))
    return df.groupBy("country").agg(total.alias("total_companies"), state.alias("government_companies"), F.try_divide(state, total).alias("government_ratio"))


def check_government(df: DataFrame, most: float = 0.10) -> None:
    """Raise if government bodies exceed their share in a country or overall."""
    found = government_summary(df).agg(F.max("government_ratio").alias("country"), F.sum("government_companies").alias("n"), F.sum("total_companies").alias("of")).first()
    if not found["of"]:
        raise ValueError("empty sample")
    if found["country"] > most + 1e-12 or found["n"] / found["of"] > most + 1e-12:
        raise AssertionError(f"government share above {most:.0%}")


def count_tables(df: DataFrame) -> DataFrame:
    """Companies by country, by size and by sector, as (dimension, value, n), from one scan."""
    cells = F.array(*[F.struct(F.lit(c).alias("dimension"), F.col(c).cast("string").alias("value")) for c in ("country", "size_bucket", "High_Level_Sector")])
    return df.select(F.explode(cells).alias("c")).groupBy("c.dimension", "c.value").agg(F.count(F.lit(1)).alias("n"))


def pool_counts(df: DataFrame) -> DataFrame:
    """df with the number of companies of its country and the number of countries."""
    per = df.groupBy(F.col("country").alias("__c")).agg(F.count(F.lit(1)).alias("company_count_for_country_in_pool"))
    total = per.agg(F.count("__c").alias("total_countries_in_pool"))
    return df.join(F.broadcast(per), F.col("country").eqNullSafe(F.col("__c"))).drop("__c").join(F.broadcast(total), F.lit(True))  # countries, one row


def seed_rows(df: DataFrame, key: str = "name") -> DataFrame:
    """One company for each country and size."""
    order = Window.partitionBy("country", "size_bucket").orderBy(key)
    return df.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def prefer_country_domain(df: DataFrame) -> DataFrame:
    """One row for each name and country: the country's own domain before a global before a foreign one."""
    once = df.dropDuplicates(["name", "country", "domain"]).withColumn("country_website_status", urls.country_status_plain(F.col("country"), F.col("domain")))
    rank = F.when(F.col("country_website_status") == "country_match", 0).when(F.col("country_website_status") == "global_or_unknown", 1).otherwise(2)
    order = Window.partitionBy("name", "country").orderBy(rank, "domain")
    return once.withColumn("__n", F.row_number().over(order)).filter("__n = 1").drop("__n")


def scrape_ready(df: DataFrame) -> DataFrame:
    """Companies whose site can be fetched: conditions on the columns that are there."""
    keep, has = F.col("final_url").isNotNull(), set(df.columns)
    if "is_website_reachable" in has:
        keep = keep & F.coalesce(F.col("is_website_reachable"), F.lit(False))
    if "content_type" in has:
        keep = keep & F.coalesce(F.col("content_type").rlike(r"(?i)text/html|application/xhtml\+xml"), F.lit(False))
    for column in ("qualification_status", "domain_match_status"):
        if column in has:
            keep = keep & (F.col(column) == "keep")
            break
    out = df.filter(keep).withColumn("scraping_ready", F.lit(True))
    return out if "company_id" in has else numbered(out)


def reachable_split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Companies that answered, and those that did not; unchecked ones are in neither."""
    require_columns(checked, ["is_website_reachable"])
    return checked.filter("is_website_reachable"), checked.filter("NOT is_website_reachable")


def crawl_input(df: DataFrame, run_size: int | None = None, seed: int = 42) -> DataFrame:
    """The columns that a crawl needs, one row for each company with an address; run_size: a sample of so many by hash."""
    needed = ["company_id", "name", "country", "size_bucket", "domain", "final_url"]
    require_columns(df, needed)
    if run_size is not None and run_size <= 0:
        raise ValueError("run_size must be positive")
    rows = last(df.select(*needed).dropna(subset=["company_id", "final_url"]), ["company_id"], "final_url", "name", "country", "size_bucket", "domain")
    return rows if run_size is None else rows.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col("company_id")).cast("binary")), "company_id").limit(run_size)
