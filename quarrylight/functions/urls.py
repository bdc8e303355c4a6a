"""URL functions as Column expressions over the parts of RFC 3986, appendix B."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import catalogue as C
from .text import any_of, strip_ws

PARTS = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def part(url: Column, group: int) -> Column:
    """2 scheme, 4 netloc, 5 path, 7 query; empty where absent."""
    return F.regexp_extract(url, PARTS, group)


def normalise_url(url: Column) -> Column:
    """Stripped, with a scheme; null if blank."""
    clean = strip_ws(url)
    return F.when(clean == "", None).when(clean.startswith("http://") | clean.startswith("https://"), clean).otherwise(F.concat(F.lit("https://"), clean))


def url_domain(url: Column) -> Column:
    """Network location in lower case without a leading www., as it stands."""
    return F.regexp_replace(F.lower(strip_ws(part(url, 4))), r"^www\.", "")


def domain_of(website: Column) -> Column:
    """Domain of a website that may lack a scheme; null if there is none."""
    netloc = F.regexp_extract(strip_ws(website), r"^(?:https?://)?([^/?#]*)", 1)
    found = F.regexp_replace(F.lower(strip_ws(netloc)), r"^www\.", "")
    return F.get(F.filter(F.array(found), lambda d: d != ""), F.lit(0))  # evaluates it once, unlike a condition on it


def clean_internal_url(url: Column) -> Column:
    """Without query, fragment and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(strip_ws(url), r"[?#].*$", ""), r"/+$", "")


def url_path(url: Column) -> Column:
    path = part(url, 5)
    return F.when(path == "", F.lit("/")).otherwise(path)


def normalised_path(url: Column) -> Column:
    """Lower case, without page extension and trailing slashes."""
    return F.regexp_replace(F.regexp_replace(F.lower(url_path(url)), r"\.(html?|php|aspx?)$", ""), r"/+$", "")


def is_excluded_url(url: Column) -> Column:
    path = normalised_path(url)
    files = "|".join(re.escape(e) for e in C.EXCLUDED_EXTENSIONS)
    return path.rlike(f"(?:{files})$") | any_of(path, C.EXCLUDED_PATHS)


def same_site(url: Column, home: Column) -> Column:
    """The url's domain is the home's or below it."""
    return (url_domain(url) == url_domain(home)) | url_domain(url).endswith(F.concat(F.lit("."), url_domain(home)))


def url_variants(website: Column) -> Column:
    """Addresses to probe: own scheme and https, without and with www."""
    url = normalise_url(website)
    base, scheme = url_domain(url), part(url, 2)
    path = F.when(part(url, 5) == "", F.lit("/")).otherwise(part(url, 5))
    tail = F.concat(path, F.when(part(url, 7) != "", F.concat(F.lit("?"), part(url, 7))).otherwise(F.lit("")))
    sites = [F.concat(s, F.lit("://"), w, base, tail) for s in (scheme, F.lit("https")) for w in (F.lit(""), F.lit("www."))]
    return F.when(F.coalesce(base, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array(*sites)))


def url_variants_plain(website: Column) -> Column:
    """The notebook's variants: the address as it is, and with www. taken off or put on; no query."""
    url = normalise_url(website)
    host = F.lower(strip_ws(part(url, 4)))
    other = F.when(host.startswith("www."), F.substring(host, 5, 10_000)).otherwise(F.concat(F.lit("www."), host))
    own = [F.concat(part(url, 2), F.lit("://"), h, part(url, 5)) for h in (host, other)]
    return F.when(F.coalesce(host, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.array(*own)))


def robots_url(url: Column) -> Column:
    return F.concat(part(url, 2), F.lit("://"), part(url, 4), F.lit("/robots.txt"))


_TWO = "|".join(re.escape(x) for x in C.TWO_PART_SUFFIXES)
_SUFFIX = rf"(?:{_TWO}|(?!\d+$)[^.]*)"


def _plain_host(domain: Column) -> Column:
    return F.regexp_replace(F.lower(strip_ws(domain)), r"^[^/]*//|[:/?#].*$", "")


def public_suffix(domain: Column) -> Column:
    """Last label, or the last two where both are a known suffix; empty for a single label or an address."""
    return F.regexp_extract(_plain_host(domain), rf"\.({_SUFFIX})$", 1)


def registered_label(domain: Column) -> Column:
    """The label before the public suffix."""
    host, pattern = _plain_host(domain), rf"(?:^|\.)(?:([^.]*)\.{_SUFFIX}|([^.]*))$"
    return F.concat(F.regexp_extract(host, pattern, 1), F.regexp_extract(host, pattern, 2))


def _top_level(domain: Column) -> Column:
    return F.regexp_extract(_plain_host(domain), r"\.((?!\d+$)[^.]*)$", 1)


def _expected(country: Column) -> Column:
    own = F.create_map(*[F.lit(x) for pair in C.COUNTRY_SUFFIX.items() for x in pair])
    return F.try_element_at(own, F.lower(strip_ws(country)))


def country_status(country: Column, domain: Column) -> Column:
    """country_match, country_mismatch (another of the ten countries), global_domain or unknown."""
    last = _top_level(domain)
    return (
        F.when(country.isNull() | domain.isNull() | (last == ""), F.lit("unknown"))
        .when(last == _expected(country), F.lit("country_match"))
        .when(last.isin(*C.COUNTRY_SUFFIX.values()), F.lit("country_mismatch"))
        .otherwise(F.lit("global_domain"))
    )


def country_status_plain(country: Column, domain: Column) -> Column:
    """The notebook's signal: any other two-letter suffix is a mismatch."""
    last, expected = _top_level(domain), _expected(country)
    none = domain.isNull() | (last == "") | expected.isNull()
    return F.when(none, F.lit("global_or_unknown")).when(last == expected, F.lit("country_match")).when(F.length(last) == 2, F.lit("country_mismatch")).otherwise(F.lit("global_or_unknown"))


def website_usable(website: Column) -> Column:
    """Looks like a company site: a host with a dot, no mail address, no file, no blocked host."""
    files = "|".join(re.escape(e) for e in C.FILE_EXTENSIONS)
    blocked = "|".join(re.escape(h) for h in C.BLOCKED_HOSTS)
    site = F.lower(strip_ws(website)).rlike(rf"(?s)^(?!.*(?:{files})$)(?=.*\.)[^@]+$")
    return F.coalesce(site & domain_of(website).rlike(rf"(?s)^(?!(?:.*\.)?(?:{blocked})$).+$"), F.lit(False))


def value_path_bonus(url: Column) -> Column:
    return F.when(any_of(F.lower(url_path(F.coalesce(url, F.lit("")))), C.VALUE_PATHS), F.lit(0.15)).otherwise(F.lit(0.0))


#: Paths of contact, news and legal pages in several languages. Fixed values.
UNWANTED_PATH = (
    r"(?i)(?:^|/)(?:contact(?:-us)?|contacto|contato|fale-conosco|kontakt|iletisim|nous-contacter|blog|news|noticias|actualites|"
    r"privacy|privacy-policy|terms|terms-and-conditions|cookies?|login|search|cart|checkout)(?:/|$)"
)


def is_unwanted_page(url: Column) -> Column:
    return F.coalesce(part(url, 5).rlike(UNWANTED_PATH), F.lit(False))
