"""Rows at the edges of what a table of documents may hold, with columns whose names operators use themselves."""

LONG = " ".join(f"word{k % 997} of the long text." for k in range(4000))
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ROWS = [
    (1, None, "a", 0), (2, "", "a", 0), (3, " \n\t ", None, 0), (4, "short text", "b", 1), (4, "short text", "b", 1),
    (5, f"before it. {PASSAGE} after it.", "b", 2), (6, PASSAGE.upper(), "", 3), (None, "a row without an id", None, 4),
    (None, None, None, 5), (7, LONG, "a", 6), (8, LONG, "b", 7), (9, "Größe naïve 東京 ok", "ä", 8), (9, "another text of id nine", "ä", 9),
]
COLUMNS = ["doc_id", "text", "source", "row", "name", "fp", "rank", "id", "c0", "score", "_id", "size", "__hits", "key"]
SCHEMA = ("doc_id long, text string, source string, row int, name string, fp long, rank int, id string, c0 string, score double, "
          "_id int, size int, __hits int, `key` string")


def edge_docs(spark):
    data = [(i, t, s, n, f"n{n}", n, n, "x", "y", 0.5, n, n, n, "k") for i, t, s, n in ROWS]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
