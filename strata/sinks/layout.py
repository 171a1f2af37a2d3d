"""Physical layout of the seven stored tables: ``<root>/<layer>/<table>/``,
Hive-partitioned Parquet.

Fact-like tables are partitioned by ``dt``.  The SCD2 dimensions carry one
storage-only column, ``closed_dt`` (the business day whose run closed the
version; ``9999-12-31`` while open), and are partitioned by
``(is_current, closed_dt)``: a merge rewrites only the current folder and
the folder of the day being run, so closed history is never read or
rewritten, and the current-row scan lists a single folder.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql.types import DateType, StructField, StructType

from strata import schemas as S

SCD2_CLOSED_COL = "closed_dt"
OPEN_CLOSED_DT = "9999-12-31"


@dataclass(frozen=True)
class TableSpec:
    layer: str
    name: str
    schema: StructType
    partition_by: tuple[str, ...]
    storage_only: tuple[StructField, ...] = field(default=())
    bucket_col: str | None = None  # key used when the table is bucketed (opt-in)
    location: str | None = None  # folder of a table registered elsewhere

    @property
    def qualified_name(self) -> str:
        return f"{self.layer}.{self.name}"

    def path(self, root: str) -> str:
        return self.location or f"{root.rstrip('/')}/{self.layer}/{self.name}"

    @property
    def storage_schema(self) -> StructType:
        return StructType(list(self.schema.fields) + list(self.storage_only))

    @property
    def is_scd2(self) -> bool:
        return bool(self.storage_only)


_CLOSED = (StructField(SCD2_CLOSED_COL, DateType(), True),)

CUSTOMERS_STG = TableSpec("bronze", "customers_stg", S.CUSTOMERS_STG, ("dt",))
PRODUCTS_STG = TableSpec("bronze", "products_stg", S.PRODUCTS_STG, ("dt",))
ORDERS_STG = TableSpec("bronze", "orders_stg", S.ORDERS_STG, ("dt",))
DIM_CUSTOMER = TableSpec(
    "silver", "dim_customer_scd2", S.DIM_CUSTOMER, ("is_current", SCD2_CLOSED_COL), _CLOSED, "customer_id"
)
DIM_PRODUCT = TableSpec(
    "silver", "dim_product_scd2", S.DIM_PRODUCT, ("is_current", SCD2_CLOSED_COL), _CLOSED, "product_id"
)
FACT_ORDERS = TableSpec("silver", "fact_orders", S.FACT_ORDERS, ("dt",))
DAILY_PRODUCT_SALES = TableSpec("gold", "daily_product_sales", S.DAILY_PRODUCT_SALES, ("dt",))

TABLES: tuple[TableSpec, ...] = (
    CUSTOMERS_STG,
    PRODUCTS_STG,
    ORDERS_STG,
    DIM_CUSTOMER,
    DIM_PRODUCT,
    FACT_ORDERS,
    DAILY_PRODUCT_SALES,
)


def table_spec(qualified_name: str) -> TableSpec:
    """The spec of a stored table by ``layer.name``."""
    for spec in TABLES:
        if spec.qualified_name == qualified_name or spec.name == qualified_name:
            return spec
    raise KeyError(f"unknown table {qualified_name!r}; known: {[t.qualified_name for t in TABLES]}")


def dimension_spec(name: str, schema: StructType, key_col: str, location: str | None = None) -> TableSpec:
    """The layout of any SCD2 dimension ``layer.name``; ``schema`` is logical
    (without the storage-only column)."""
    layer, _, table = name.rpartition(".")
    return TableSpec(layer or "default", table, schema, ("is_current", SCD2_CLOSED_COL), _CLOSED, key_col, location)


def in_namespace(spec: TableSpec, ns: str | None) -> TableSpec:
    """The same table under a private namespace: database ``<ns>_<layer>``
    and folder ``<root>/<ns>_<layer>/<table>`` (``ns=None``: unchanged)."""
    return replace(spec, layer=f"{ns}_{spec.layer}") if ns else spec
