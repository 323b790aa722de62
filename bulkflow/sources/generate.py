"""Generated load batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Product categories.
CATEGORIES = ["Electronics", "Clothing", "Home", "Garden", "Toys", "Books", "Tools"]
PRODUCT_FIELDS = 20
# Position of each useful field of a product record.
PRODUCT_POSITIONS = {
    1: "DESCRIPTION",
    2: "ID",
    4: "CODE",
    5: "TARGET_LEVEL",
    7: "NAME",
    9: "PRICE",
    11: "REORDER_LEVEL",
    13: "CATEGORY",
    16: "DISCONTINUED",
    18: "COST",
}


def bulk_data(spark: SparkSession, n: int, created_at: Column) -> DataFrame:
    """Rows with the ids 1..n."""
    return bulk_data_for(spark.range(1, n + 1), created_at)


def bulk_data_for(ids: DataFrame, created_at: Column) -> DataFrame:
    """A row with derived texts for each ``id``; every tenth id is inactive; one stamp for all rows."""
    i = F.col("id")
    return ids.select(
        i.alias("ID"),
        F.concat(F.lit("VAL_"), i).alias("DATA_VALUE"),
        F.concat(F.lit("Generated row #"), i).alias("DESCRIPTION"),
        F.when(i % 10 == 0, "INACTIVE").otherwise("ACTIVE").alias("STATUS"),
        created_at.alias("CREATED_AT"),
    )


def constant_batch(keys: DataFrame, stamp: Column) -> DataFrame:
    """One row per key of a table, all with the same stamp."""
    return keys.select("*", stamp.alias("updated_at"))


def next_ids(table: DataFrame, id_column: str, n: int, committed_at: Column) -> DataFrame:
    """``n`` new rows whose ids go on after the largest id of ``table`` (1 when it is empty)."""
    return next_ids_for(table.sparkSession.range(1, n + 1), table, id_column, committed_at)


def next_ids_for(numbers: DataFrame, table: DataFrame, id_column: str, committed_at: Column) -> DataFrame:
    """A new row for each ``id`` of ``numbers``, which count on from the largest id of ``table`` (0 when it is empty)."""
    start = table.agg(F.coalesce(F.max(id_column), F.lit(0))).scalar()
    total = numbers.agg(F.count(F.lit(1))).scalar()
    i = F.col("id")
    new_id = (start + i).cast("bigint")
    return numbers.select(
        new_id.alias("ID"),
        F.concat(F.lit("PID-"), new_id).alias("PID"),
        F.concat(F.lit("DATA_"), i).alias("DATA_VALUE"),
        F.concat(F.lit("Record "), i, F.lit(" of "), total).alias("DESCRIPTION"),
        F.lit("ACTIVE").alias("STATUS"),
        committed_at.alias("COMMITTED_AT"),
    )


def _draw(i: Column, seed: int, start: int, length: int) -> Column:
    """A repeatable random number: some hexadecimal digits of a digest of seed and id."""
    digest = F.md5(F.concat(F.lit(f"{seed}-"), i).cast("binary"))
    return F.conv(F.substring(digest, start, length), 16, 10).cast("bigint")


def _money(cents: Column) -> Column:
    """Whole cents as text with two decimals."""
    units = F.floor(cents / 100).cast("bigint").cast("string")
    return F.concat(units, F.lit("."), F.lpad((cents % 100).cast("string"), 2, "0"))


def products(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Product records with the ids 1..n."""
    return products_for(spark.range(1, n + 1), seed)


def products_for(ids: DataFrame, seed: int = 42) -> DataFrame:
    """A product record for each ``id``: about 20 % empty descriptions, 10 % empty levels, 5 % discontinued."""
    i = F.col("id")
    cents = 1000 + _draw(i, seed, 9, 6) % 10000
    category = F.element_at(
        F.array(*[F.lit(c) for c in CATEGORIES]), (_draw(i, seed, 5, 4) % len(CATEGORIES) + 1).cast("int")
    )
    return ids.select(
        i.cast("string").alias("ID"),
        F.concat(F.lit("PROD-"), F.when(i < 10**8, F.lpad(i.cast("string"), 8, "0")).otherwise(i.cast("string"))).alias("CODE"),
        F.concat(F.lit("Product Name "), i).alias("NAME"),
        F.when(_draw(i, seed, 1, 4) % 100 < 20, "")
        .otherwise(F.concat(F.lit("Description for product "), i, F.lit(" with some details.")))
        .alias("DESCRIPTION"),
        category.alias("CATEGORY"),
        _money(cents).alias("COST"),
        _money(F.floor((cents * 3 + 1) / 2).cast("bigint")).alias("PRICE"),
        F.when(_draw(i, seed, 15, 4) % 100 < 10, "")
        .otherwise((_draw(i, seed, 19, 4) % 50).cast("string"))
        .alias("REORDER_LEVEL"),
        F.when(_draw(i, seed, 23, 4) % 100 < 10, "")
        .otherwise((50 + _draw(i, seed, 27, 4) % 100).cast("string"))
        .alias("TARGET_LEVEL"),
        F.when(_draw(i, seed, 31, 2) % 100 < 5, "1").otherwise("0").alias("DISCONTINUED"),
    )


def scatter(rows: DataFrame, positions: dict[int, str], width: int, id_column: str) -> DataFrame:
    """Spread the useful columns over ``width`` fields, filling the others with junk."""
    out = []
    for j in range(width):
        if j in positions:
            out.append(F.col(positions[j]).cast("string").alias(positions[j]))
        else:
            out.append(F.concat(F.lit("junk_"), F.col(id_column), F.lit(f"_{j}")).alias(f"JUNK_{j}"))
    return rows.select(*out)


def product_file(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """Product records as they stand in the 20-field file."""
    return scatter(products(spark, n, seed), PRODUCT_POSITIONS, PRODUCT_FIELDS, "ID")
