"""The sample tables seen as a claims table, so that every operator can run on them.

One claims row is one order line, whichever columns are asked for. Codes come from the dimension tables; a binding joins only the
tables that the asked columns need, and Catalyst prunes what is left. No side is forced to be
broadcast: Spark does so for dimension files it knows to be small and joins by shuffle otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimworks.functions import month_key
from claimworks.schema import AMOUNT_TYPE
from claimworks.session import drop_dir, freed_shuffles, scratch_dir, settings


HASHED = "32m"  # a shuffled side whose parts all stay below this is hashed, not sorted
# What the claims table takes of an order line.
LINE = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _amount(name: str) -> Column:
    return F.col(name).cast(AMOUNT_TYPE)


def _columns() -> dict[str, tuple[str, Column]]:
    """Claims column → (dimension table it needs, expression)."""
    price = _amount("l_extendedprice")
    raw = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
    zero = F.lit(0).cast(AMOUNT_TYPE)
    excluded = (F.col("l_returnflag") != "N") & (F.col("l_linenumber") > 2)
    quantity = _amount("l_quantity")
    age = (
        F.when(F.col("p_size") == 50, "99")
        .when(F.col("p_size") < 40, (F.col("p_size") - F.col("p_size") % 10).cast("string"))
    )
    scope = F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "R", "0")
    kind = F.when(F.col("l_returnflag") == "N", "99")
    return {
        "FLX_ANN_MOI": ("lineitem", month_key("l_shipdate")),
        "BEN_RES_REG": ("customer", F.col("c_nationkey").cast("string")),
        "AGE_BEN_SNDS": ("part", age),
        "BEN_SEX_COD": ("lineitem", (F.col("l_linenumber") % 2 + 1).cast("string")),
        "PRS_NAT": ("supplier", F.lpad(F.col("s_nationkey").cast("string"), 4, "0")),
        "PRS_REM_TYP": ("lineitem", kind.otherwise((F.col("l_linenumber") - 1).cast("string"))),
        "SOI_ANN": ("orders", F.year("o_orderdate").cast("string")),
        "SOI_MOI": ("orders", F.lpad(F.month("o_orderdate").cast("string"), 2, "0")),
        "TOP_PS5_TRG": ("lineitem", scope.otherwise("9")),
        "PRS_DEP_MNT": ("lineitem", _amount("l_tax")),
        "PRS_PAI_MNT": ("lineitem", price),
        "PRS_REM_BSE": ("lineitem", _amount("l_discount")),
        "PRS_REM_MNT": ("lineitem", raw),
        "FLT_PAI_MNT": ("lineitem", price),
        "FLT_DEP_MNT": ("lineitem", _amount("l_tax")),
        "FLT_REM_MNT": ("lineitem", F.when(excluded, zero).otherwise(raw)),
        "PRS_ACT_COG": ("lineitem", quantity),
        "PRS_ACT_NBR": ("lineitem", F.when(F.col("l_linestatus") != "F", quantity)),
        "PRS_ACT_QTE": ("lineitem", quantity),
        "FLT_ACT_COG": ("lineitem", quantity),
        "FLT_ACT_NBR": ("lineitem", F.when(F.col("l_linestatus") != "F", quantity)),
        "FLT_ACT_QTE": ("lineitem", quantity),
        "PRS_REM_TAU": ("lineitem", _amount("l_discount")),
    }


def alike(columns: list[str]) -> dict[str, str]:
    """Each claims column and the first of the columns that are bound to the same expression."""
    first: dict[str, str] = {}
    mapping = _columns()
    return {c: first.setdefault(str(mapping[c][1]), c) for c in columns}


def stored_lines(spark: SparkSession, folder: str) -> tuple[DataFrame, str]:
    """The order lines with what the claims table takes of the other tables, stored; ``(rows, their folder)``.

    For claims that are read more than once, or dealt out. The rows are stored after every join, while
    they are narrow, and the shuffle files and the rows of the join before are dropped then; so the disk
    holds one join at a time. Customers are joined to orders, which are fewer than their lines.
    """
    customer = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    orders = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")
    others = (
        ("l_orderkey", orders, "o_orderkey"),
        ("l_partkey", table(spark, folder, "part").select("p_partkey", "p_size"), "p_partkey"),
        ("l_suppkey", table(spark, folder, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey"),
    )
    rows, before = table(spark, folder, "lineitem").select(*LINE), None
    for key, other, name in others:
        joined = rows.join(other, F.col(key) == F.col(name), "left").drop(name, *({key} - {"l_orderkey"}))
        path = scratch_dir(spark, "lines")
        with freed_shuffles(spark), settings(spark, spark__sql__adaptive__maxShuffledHashJoinLocalMapThreshold=HASHED):
            joined.write.option("compression", "zstd").parquet(path)
        if before:
            drop_dir(spark, before)
        rows, before = spark.read.schema(joined.schema).parquet(path), path
    return rows, before


def claims_of(lines: DataFrame, keep: list[str] | None = None, deal: str | None = None) -> DataFrame:
    """The claims table with all columns from :func:`stored_lines`."""
    return _bound(lines, list(_columns()), keep, deal)


def claims(
    spark: SparkSession, folder: str, columns: list[str] | None = None, keep: list[str] | None = None,
    deal: str | None = None,
) -> DataFrame:
    """The claims table with the asked columns, plus columns of the order line to ``keep``.

    With ``deal`` rows are dealt out by the month of that column of the order line, before the claims
    columns are made of the few columns that travel.
    """
    mapping = _columns()
    columns = list(mapping) if columns is None else list(columns)
    needed = {mapping[c][0] for c in columns}
    rows = table(spark, folder, "lineitem")
    if needed & {"orders", "customer"}:
        orders = table(spark, folder, "orders")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    if "customer" in needed:
        customer = table(spark, folder, "customer")
        rows = rows.join(customer, F.col("o_custkey") == customer.c_custkey, "left")
    if "supplier" in needed:
        supplier = table(spark, folder, "supplier")
        rows = rows.join(supplier, F.col("l_suppkey") == supplier.s_suppkey, "left")
    if "part" in needed:
        part = table(spark, folder, "part")
        rows = rows.join(part, F.col("l_partkey") == part.p_partkey, "left")
    return _bound(rows, columns, keep, deal)


def _bound(rows: DataFrame, columns: list[str], keep: list[str] | None, deal: str | None) -> DataFrame:
    mapping = _columns()
    if deal:
        rows = rows.withColumn("_month", month_key(deal)).hint("rebalance", "_month")
    return rows.select(*[mapping[c][1].alias(c) for c in columns], *(keep or []))


def revision(
    spark: SparkSession, folder: str, columns: list[str] | None = None, keep: list[str] | None = None,
    deal: str | None = None,
) -> DataFrame:
    """The claims table with a ``month`` of its file and some damage for the gate to find.

    A few orders lose their month, have a type nobody knows, or miss the reimbursement.
    """
    return _revised(claims(spark, folder, columns, keep=["l_orderkey", "l_shipdate"], deal=deal), keep)


def revision_of(lines: DataFrame, keep: list[str] | None = None, deal: str | None = None) -> DataFrame:
    """The same with all columns from :func:`stored_lines`."""
    return _revised(claims_of(lines, ["l_orderkey", "l_shipdate"], deal), keep)


def _revised(rows: DataFrame, keep: list[str] | None) -> DataFrame:
    key = F.col("l_orderkey")
    damage = {
        "FLX_ANN_MOI": F.when(key % 1009 != 0, F.col("FLX_ANN_MOI")),
        "PRS_REM_TYP": F.when(key % 1013 == 1, "999").otherwise(F.col("PRS_REM_TYP")),
        "FLT_REM_MNT": F.when(key % 1019 != 2, F.col("FLT_REM_MNT")),
    }
    return (
        rows.withColumns({c: e for c, e in damage.items() if c in rows.columns})
        .withColumn("month", month_key("l_shipdate"))
        .drop(*({"l_orderkey", "l_shipdate"} - set(keep or [])))
    )


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """Nation names as labels of services and regions; five codes of each stay without one."""
    nation = table(spark, folder, "nation").where("n_nationkey < 20")
    code = F.col("n_nationkey").cast("string")
    services = nation.select(
        F.lit("PRS_NAT").alias("variable"), F.lpad(code, 4, "0").alias("code"),
        F.col("n_name").alias("libelle"),
    )
    regions = nation.select(
        F.lit("BEN_RES_REG").alias("variable"), code.alias("code"), F.col("n_name").alias("libelle")
    )
    return services.unionByName(regions)


def as_text(df: DataFrame, amounts: list[str], variant: Column) -> DataFrame:
    """Amounts the way people type them: points or commas, padding, an optional plus.

    ``variant`` 0 to 3 picks the spelling of a row; the amounts stay the same.
    """

    def spelled(c: str) -> Column:
        plain = F.col(c).cast("string")
        comma = F.replace(plain, F.lit("."), F.lit(","))
        plus = F.when(F.col(c) >= 0, F.concat(F.lit("+"), plain)).otherwise(plain)
        return (
            F.when(variant == 0, plain)
            .when(variant == 1, comma)
            .when(variant == 2, F.concat(F.lit("  "), comma, F.lit(" ")))
            .otherwise(plus)
        )

    return df.withColumns({c: spelled(c) for c in amounts})
