"""Search: three ways to find a medicine, of which the first that finds any counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cascade(queries: DataFrame, medicines: DataFrame, limits: tuple[int, int, int] = (50, 25, 50)) -> DataFrame:
    """(query, branch, medicine_id): by salt key, else by a word of the title, else by a salt key that starts with the query."""
    q = queries.select("query", F.lower(F.trim("query")).alias("q"))
    m = medicines.select("medicine_id", "title", F.lower("salt_key").alias("salt"))
    one = q.join(m, F.col("q") == F.col("salt")).select("query", F.lit(1).alias("branch"), "medicine_id", "title")
    word = m.select("medicine_id", "title", F.explode(F.array_distinct(F.split(F.lower("title"), r"\s+"))).alias("w"))
    two = q.join(word, F.col("q") == F.col("w")).select("query", F.lit(2).alias("branch"), "medicine_id", "title")
    # Prefixes become an equi-join: salts by each of their prefixes, made once per distinct salt.
    prefixes = m.select("salt").distinct().select("salt", F.explode(F.expr("transform(sequence(1, char_length(salt)), i -> left(salt, i))")).alias("p"))
    three = q.join(prefixes, F.col("q") == F.col("p")).join(m, "salt").select("query", F.lit(3).alias("branch"), "medicine_id", "title")
    every = one.unionByName(two).unionByName(three)
    # The most that a branch may give is taken of each branch first, so that the choice among branches sees few rows of a query.
    rank = F.row_number().over(Window.partitionBy("query", "branch").orderBy("title", "medicine_id"))
    limit = F.element_at(F.array(*[F.lit(x) for x in limits]), F.col("branch"))
    top = every.withColumn("rn", rank).where(F.col("rn") <= max(limits)).where(F.col("rn") <= limit)
    return top.withColumn("first", F.min("branch").over(Window.partitionBy("query"))).where("branch = first").select("query", "branch", "medicine_id")
