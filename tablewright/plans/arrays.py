"""Arrays, matrices, sets, maps and literal demonstrations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import scalars as S
from ..sources.readers import read_table
from .profiles import rounded
from .registry import example, query


def one(spark):
    return spark.range(1)


@example("SELECT [1, 2, 3]::INT[] AS a, 3::INT AS n, 'array<int>' AS type, [0, 0]::DOUBLE[] AS zeros, [[7, 7, 7], [7, 7, 7]]::DOUBLE[][] AS sevens")
def array_construction(spark, d):
    """Arrays, their size and type, filled arrays."""
    a = F.array(*[F.lit(x) for x in (1, 2, 3)])
    return one(spark).select(a.alias("a"), F.size(a).alias("n"), F.typeof(a).alias("type"), A.full((2,), 0.0).alias("zeros"), A.full((2, 3), 7.0).alias("sevens"))


@example("SELECT range(2, 10)::INT[] AS plain, range(0, 10, 3)::INT[] AS stepped, [10, 7, 4]::INT[] AS falling, []::INT[] AS none")
def array_ranges(spark, d):
    """Ranges without their end."""
    return one(spark).select(A.arange(2, 10).alias("plain"), A.arange(0, 10, 3).alias("stepped"), A.arange(10, 1, -3).alias("falling"), A.arange(5, 2).alias("none"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 8, 1) AS rounded FROM lineitem")
def half_even(spark, d):
    """Rounding of halves to even."""
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", S.half_even(F.col("l_quantity") / 8, 1).alias("rounded"))


@example()
def random_numbers(spark, d):
    """Seeded random numbers."""
    return spark.range(100).select("id", F.rand(7).alias("uniform"), F.randn(7).alias("normal"), F.floor(F.rand(8) * 10).alias("whole"))


@example("SELECT [[1, 2, 3], [4, 5, 6]]::INT[][] AS vertical, [1, 2, 3, 4, 5, 6]::INT[] AS horizontal, [[1, 4], [2, 5], [3, 6]]::INT[][] AS columns")
def array_stacks(spark, d):
    """Arrays stacked by rows, end to end and by columns."""
    a, b = (F.array(*[F.lit(x) for x in xs]) for xs in ((1, 2, 3), (4, 5, 6)))
    return one(spark).select(F.array(a, b).alias("vertical"), F.concat(a, b).alias("horizontal"), F.zip_with(a, b, lambda x, y: F.array(x, y)).alias("columns"))


@example("SELECT [4, 5]::INT[] AS both_in, [1, 2, 3]::INT[] AS only_a, [6, 7, 8]::INT[] AS only_b")
def array_setops(spark, d):
    """Common elements and differences."""
    a, b = (F.array(*[F.lit(x) for x in xs]) for xs in ((1, 2, 3, 4, 5), (4, 5, 6, 7, 8)))
    return one(spark).select(A.intersect(a, b).alias("both_in"), A.difference(a, b).alias("only_a"), A.difference(b, a).alias("only_b"))


@example("SELECT [[-4, -5, -6], [-1, -2, -3]]::INT[][] AS less, [2, 4, 6]::INT[] AS doubled, [5, 7, 9]::INT[] AS added")
def array_broadcast(spark, d):
    """Element by element, and a row against each row."""
    a, b = F.array(*[F.lit(x) for x in (1, 2, 3)]), F.array(*[F.lit(x) for x in (4, 5, 6)])
    added = F.zip_with(a, b, lambda x, y: x + y)
    return one(spark).select(A.each_minus(F.array(a, b), added).alias("less"), F.transform(a, lambda x: x * 2).alias("doubled"), added.alias("added"))




@query("""
WITH a AS (SELECT vec_id AS i, unnest(range(64))::INT AS j, unnest(embedding)::DOUBLE AS v FROM embeddings)
, g AS (SELECT label AS i, vec_id AS j, 1::DOUBLE AS v FROM embeddings)
SELECT g.i, a.j, round(sum(g.v * a.v), 5) AS v FROM g JOIN a ON g.j = a.i GROUP BY 1, 2""")
def matmul(spark, d):
    """A product of matrices in long form (X9): labels by vectors, times vectors."""
    df = read_table(spark, d, "embeddings")
    vectors = A.to_long(df, "vec_id", "embedding").withColumn("v", F.col("v").cast("double"))
    labels = df.select(F.col("label").alias("i"), F.col("vec_id").alias("j"), F.lit(1.0).alias("v"))
    return rounded(A.matmul(labels, vectors), 5, "v")


@query("""
WITH a AS (SELECT vec_id AS i, unnest(range(64))::BIGINT AS j, unnest(embedding)::DOUBLE AS v FROM embeddings)
SELECT x.j AS i, y.j AS j, round(sum(x.v * y.v), 5) AS v FROM a x JOIN a y USING (i) GROUP BY 1, 2""")
def gram_matrix(spark, d):
    """Products of all pairs of columns (X9): the transposed vectors times the vectors, in blocks."""
    vectors = A.to_long(read_table(spark, d, "embeddings"), "vec_id", "embedding").withColumn("j", F.col("j").cast("long"))
    return rounded(A.block_matmul(A.transpose(vectors), vectors), 5, "v")


@example("SELECT * FROM (VALUES (0, 0, 76.0), (0, 1, 82.0), (1, 0, 184.0), (1, 1, 199.0), (2, 0, 292.0), (2, 1, 316.0)) t(i, j, v)")
def matmul_literal(spark, d):
    """A small product with known cells."""
    a = spark.createDataFrame([(i, j, float(3 * i + j + 1)) for i in range(3) for j in range(3)], "i int, j int, v double")
    b = spark.createDataFrame([(i, j, float(10 + 2 * i + j)) for i in range(3) for j in range(2)], "i int, j int, v double")
    return A.matmul(a, b)


@example("SELECT * FROM (VALUES (0, 0, 1.0::DOUBLE), (1, 0, 2.0), (0, 1, 3.0), (1, 1, 4.0)) t(i, j, v)")
def transpose(spark, d):
    """A transposed matrix."""
    return A.transpose(spark.createDataFrame([(0, 0, 1.0), (0, 1, 2.0), (1, 0, 3.0), (1, 1, 4.0)], "i int, j int, v double"))


@query("SELECT vec_id, embedding[1:3]::DOUBLE[] AS first, embedding[64]::DOUBLE AS last, embedding[11:15]::DOUBLE[] AS inner_part FROM embeddings")
def array_slices(spark, d):
    """Slices and single elements."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    return read_table(spark, d, "embeddings").select("vec_id", F.slice(e, 1, 3).alias("first"), F.element_at(e, -1).alias("last"), F.slice(e, 11, 5).alias("inner_part"))


@query("SELECT vec_id, [embedding[i:i + 15]::DOUBLE[] FOR i IN range(1, 65, 16)] AS m FROM embeddings")
def array_reshape(spark, d):
    """A vector of 64 as four rows of 16 (X11)."""
    e = F.transform("embedding", lambda x: x.cast("double"))
    return read_table(spark, d, "embeddings").select("vec_id", F.transform(F.sequence(F.lit(1), F.lit(64), F.lit(16)), lambda i: F.slice(e, i, 16)).alias("m"))


@query("SELECT vec_id, round(sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])), 6) AS norm FROM embeddings")
def vector_norms(spark, d):
    """Lengths of vectors."""
    return read_table(spark, d, "embeddings").select("vec_id", F.round(A.norm(F.col("embedding")), 6).alias("norm"))


@query("WITH n AS (SELECT vec_id, embedding, sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])) AS n FROM embeddings) SELECT vec_id, [round(x::DOUBLE / n, 6) FOR x IN embedding] AS unit FROM n")
def l2_normalise(spark, d):
    """Vectors scaled to length 1."""
    return read_table(spark, d, "embeddings").select("vec_id", F.transform(A.over_length(F.col("embedding")), lambda x: S.rounded_up(x, 6)).alias("unit"))


@example("SELECT x::INT AS x, y AS y FROM range(3) t(x), (VALUES ('a'), ('b')) u(y)")
def mesh(spark, d):
    """All combinations of two short lists."""
    return spark.range(3).select(F.col("id").cast("int").alias("x")).crossJoin(spark.createDataFrame([("a",), ("b",)], "y string"))  # three times two rows


@example("""SELECT 10::INT AS first, 40::INT AS last, [10, 20, 30, 40, 50]::INT[] AS appended, [10, 99, 30, 40]::INT[] AS updated, [10, 30, 40]::INT[] AS deleted,
  4::INT AS n, [40, 30, 20, 10]::INT[] AS falling, [20, 30]::INT[] AS part, [10, 20, 30, 40, 1, 2]::INT[] AS joined""")
def list_operations(spark, d):
    """Operations on a list."""
    a = F.array(*[F.lit(x) for x in (10, 20, 30, 40)])
    return one(spark).select(
        a[0].alias("first"), F.element_at(a, -1).alias("last"), F.array_append(a, 50).alias("appended"), F.transform(a, lambda x, i: F.when(i == 1, 99).otherwise(x)).alias("updated"), F.filter(a, lambda x, i: i != 1).alias("deleted"),
        F.size(a).alias("n"), F.sort_array(a, asc=False).alias("falling"), F.slice(a, 2, 2).alias("part"), F.concat(a, F.array(F.lit(1), F.lit(2))).alias("joined"),
    )


@example("SELECT 'x' AS first, 2::INT AS second, 2::INT AS n")
def tuple_fields(spark, d):
    """A record of fixed fields."""
    t = F.struct(F.lit("x").alias("a"), F.lit(2).alias("b"))
    return one(spark).select(t["a"].alias("first"), t["b"].alias("second"), F.size(F.array(t["a"], t["b"].cast("string"))).alias("n"))


@example("""SELECT 1::INT AS got, 9::INT AS put, 5::INT AS updated, false AS deleted_left, 2::INT AS n, ['a', 'b'] AS names, [1, 2]::INT[] AS vals, '{"a":1,"b":2}' AS shown""")
def map_operations(spark, d):
    """Operations on a map."""
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    other = lambda k, v: F.map_concat(F.map_filter(m, lambda key, _: key != k), F.create_map(F.lit(k), F.lit(v)))
    return one(spark).select(
        m["a"].alias("got"), other("c", 9)["c"].alias("put"), other("a", 5)["a"].alias("updated"), F.map_contains_key(F.map_filter(m, lambda k, _: k != "a"), "a").alias("deleted_left"), F.size(m).alias("n"),
        F.map_keys(m).alias("names"), F.map_values(m).alias("vals"), F.to_json(m).alias("shown"),
    )


@example("SELECT [3.5, 4.0, 12.25]::DOUBLE[] AS numbers")
def split_numbers(spark, d):
    """Numbers parted by commas or blanks in one text."""
    words = F.split(F.translate(F.lit("3.5, 4, 12.25"), ",", " "), r"\s+")
    return one(spark).select(F.transform(words, lambda w: w.cast("double")).alias("numbers"))
