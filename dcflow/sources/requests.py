"""Request rows (set, from, until) -> ListRecords URLs, as DataFrame columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the protocol request: the verb and the default metadata format.
VERB = "ListRecords"
DEFAULT_PREFIX = "oai_dc"
# Placeholder endpoint; callers pass their repository's base URL.
DEFAULT_BASE_URL = "https://example.org/oai"


def request_url(set_spec: Column, from_date: Column, until_date: Column,
                base_url: str = DEFAULT_BASE_URL, metadata_prefix: str = DEFAULT_PREFIX) -> Column:
    """``base?verb=ListRecords&metadataPrefix=p[&set=s][&from=f][&until=u]``.

    Optional arguments that are NULL or empty are left out of the URL.
    """
    def opt(name: str, c: Column) -> Column:
        txt = c.cast("string")
        return F.when(F.length(txt) > 0, F.concat(F.lit(f"&{name}="), txt))

    return F.concat_ws("",
                       F.lit(f"{base_url}?verb={VERB}&metadataPrefix={metadata_prefix}"),
                       opt("set", set_spec), opt("from", from_date), opt("until", until_date))


def build_requests(plan: DataFrame, base_url: str = DEFAULT_BASE_URL,
                   metadata_prefix: str = DEFAULT_PREFIX) -> DataFrame:
    """Add ``url`` to a plan with ``set_spec``, ``from_date``, ``until_date``."""
    return plan.withColumn("url", request_url(F.col("set_spec"), F.col("from_date"),
                                              F.col("until_date"), base_url, metadata_prefix))
