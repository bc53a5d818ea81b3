"""Dictionary, set and order-aligned joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lookup(df: DataFrame, key: Column, dictionary: DataFrame, dict_key: str, values: dict[str, object], upper: bool = False) -> DataFrame:
    """Left join with a dictionary; ``values`` maps its columns to defaults
    (None: null).  Spark broadcasts it if it is small enough."""
    k = F.upper(key) if upper else key
    d = dictionary.select((F.upper(dict_key) if upper else F.col(dict_key)).alias("__k"), *values)
    out = df.withColumn("__key", k).join(d, F.col("__key") == F.col("__k"), "left").drop("__k", "__key")
    fill = {c: v for c, v in values.items() if v is not None}
    return out.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})


def in_list(df: DataFrame, key: str, other: DataFrame, other_key: str, keep: bool = True) -> DataFrame:
    """Rows whose key is (or isn't) in another table."""
    return df.join(other.select(F.col(other_key).alias("__o")), F.col(key) == F.col("__o"), "left_semi" if keep else "left_anti")


def diff(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Full outer comparison on a key: flag < (only a), > (only b), = or |
    (differs), and b's value less a's."""
    left, right = a.select(key, F.col(value).alias("left_value")), b.select(key, F.col(value).alias("right_value"))
    out = left.withColumn("__l", F.lit(1)).join(right.withColumn("__r", F.lit(1)), key, "full_outer")
    flag = F.when(F.col("__r").isNull(), "<").when(F.col("__l").isNull(), ">").when(F.col("left_value").eqNullSafe(F.col("right_value")), "=").otherwise("|")
    return out.select(key, "left_value", "right_value", flag.alias("flag"), (F.col("right_value") - F.col("left_value")).alias("difference"))


def diff_summary(compared: DataFrame) -> DataFrame:
    n = lambda f: F.count_if(F.col("flag") == f)
    both = n("=") + n("|")
    return compared.agg(
        n("<").alias("only_left"), n(">").alias("only_right"), both.alias("both"), n("=").alias("exact"),
        F.coalesce(F.try_divide(100.0 * n("="), both), F.lit(0.0)).alias("exact_percent"), F.avg("difference").alias("mean_difference"),
    )


def every_pair(df: DataFrame, few: DataFrame, most_rows: int = 10_000) -> DataFrame:
    """Each row with each row of a table whose size is checked."""
    if few.limit(most_rows + 1).count() > most_rows:
        raise ValueError(f"more than {most_rows} rows to pair with every row")
    return df.crossJoin(F.broadcast(few))


def external_map(pairs: DataFrame, external: str, internal: str) -> DataFrame:
    """The external ids of each internal one, as a sorted list."""
    return pairs.groupBy(internal).agg(F.array_sort(F.collect_set(external)).alias("externals"))


def ortholog_classes(members: DataFrame, event: str, side: str, species: str, gene: str) -> DataFrame:
    """(event, species_a, species_b, class) of the two sides (1, 2) of events,
    by how many genes each species has on its side."""
    sized = members.groupBy(event, side, species).agg(F.count_distinct(gene).alias("n"))
    a = sized.filter(F.col(side) == 1).select(event, F.col(species).alias("species_a"), F.col("n").alias("na"))
    b = sized.filter(F.col(side) == 2).select(event, F.col(species).alias("species_b"), F.col("n").alias("nb"))
    word = lambda c: F.when(F.col(c) == 1, "one").otherwise("many")
    return a.join(b, event).select(event, "species_a", "species_b", F.concat(word("na"), F.lit("2"), word("nb")).alias("class"))


def by_any_key(df: DataFrame, key: str, dictionary: DataFrame, dict_keys: list[str], values: list[str]) -> DataFrame:
    """Left join with a dictionary whose entries go by several keys each; an
    entry that goes by one key twice counts once."""
    keyed = dictionary.select(F.explode(F.array_distinct(F.array_compact(F.array(*[F.col(k).cast("string") for k in dict_keys])))).alias("__k"), *values).distinct()
    return df.join(keyed, F.col(key) == F.col("__k"), "left").drop("__k")


def override(df: DataFrame, key: str, changes: DataFrame, change_key: str, columns: dict[str, str]) -> DataFrame:
    """Columns (column -> the changes' column) take the changes' values where
    these have one for the row's key."""
    new = changes.select(F.col(change_key).alias("__k"), *[F.col(v).alias(f"__{c}") for c, v in columns.items()])
    out = df.join(new, F.col(key) == F.col("__k"), "left")
    return out.withColumns({c: F.coalesce(f"__{c}", c) for c in columns}).drop("__k", *[f"__{c}" for c in columns])


def found(df: DataFrame, key: str, sorted_keys: DataFrame, other: str, name: str = "found") -> DataFrame:
    """Adds whether a row's key is in a table; Spark sorts or hashes it once."""
    known = sorted_keys.select(F.col(other).alias("__k")).distinct()
    return df.join(known, F.col(key) == F.col("__k"), "left").withColumn(name, F.col("__k").isNotNull()).drop("__k")


def ranked_by_list(df: DataFrame, key: str, order: DataFrame, name: str, place: str) -> DataFrame:
    """Adds a row's place in an external order (name, place); keys that the
    order lacks have none and sort last."""
    return df.join(order.select(F.col(name).alias("__k"), F.col(place).alias("order_place")), F.col(key) == F.col("__k"), "left").drop("__k")
