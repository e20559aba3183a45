"""Tenant databases over JDBC; Spark opens the connections and pushes the filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docloom.model import IndexDef, Tenant
from docloom.sources.tables import PerTenant, tag_tenant

# Connection URL per vendor.
URLS = {
    "mysql": "jdbc:mysql://{host}:{port}/{schema}",
    "mssql": "jdbc:sqlserver://{host}:{port};databaseName={schema}",
    "oracle": "jdbc:oracle:thin:@{host}:{port}:{schema}",
}

SPLIT_OPTIONS = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")


def jdbc_options(tenant: Tenant, query: str) -> dict[str, str]:
    """Reader options of one tenant's query.

    ``tenant.source`` gives ``url``, or ``host``, ``port`` and ``schema`` with the
    tenant's vendor; further keys go to the reader unchanged.  With a
    ``partitionColumn`` the read is split over ``numPartitions`` ranges, which the
    reader allows only for a sub-select given as ``dbtable``.
    """
    source = dict(tenant.source)
    where = {key: source.pop(key, "") for key in ("host", "port", "schema")}
    if "url" not in source:
        vendor = (tenant.vendor or "").lower()
        if vendor not in URLS:
            raise ValueError(f"tenant {tenant.id}: no URL and unknown vendor {tenant.vendor!r}")
        source["url"] = URLS[vendor].format(**where)
    text = query.strip().rstrip(";")
    if "partitionColumn" in source:
        missing = [key for key in SPLIT_OPTIONS if key not in source]
        if missing:
            raise ValueError(f"tenant {tenant.id}: split read needs {', '.join(missing)}")
        source["dbtable"] = f"({text}) q"
    else:
        source["query"] = text
    return source


class TenantJdbc(PerTenant):
    """One database per tenant; each tenant gets the text written for its vendor."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def tenant_rows(self, index: IndexDef, tenant: Tenant) -> DataFrame:
        options = jdbc_options(tenant, index.query_for(tenant.vendor))
        return tag_tenant(self.spark.read.format("jdbc").options(**options).load(), tenant.id)
