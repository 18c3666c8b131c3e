"""Small documents with every odd case, and helpers for brute-force checks."""

from pyspark.sql import types as T

#: Extra columns carry names that operators use for their own results.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()), T.StructField("size", T.StringType()),
    T.StructField("score", T.StringType()), T.StructField("rank", T.StringType()),
    T.StructField("_size", T.StringType()), T.StructField("_key", T.StringType()),
])

LONG = " ".join(f"word{k % 997}x{k % 13}" for k in range(30_000))


def row(doc_id, text, lang="en", source="src0"):
    return (doc_id, text, lang, source, None if text is None else len(text),
            "a", "b", "c", "d", "e")


def messy_rows():
    rows = [row(k, f"the quick brown fox number {k} jumps over lazy dogs " * (1 + k % 7),
                ["en", "de", "fr"][k % 3], f"src{k % 4}") for k in range(1, 60)]
    rows += [row(100, None), row(101, ""), row(102, "   \t\n "), row(103, LONG),
             row(104, "single"), row(105, "two words"), row(106, "żółw 日本語 \U0001f600 naïve"),
             row(107, "no lang", None, None), row(None, "without an id", "en", None),
             row(None, None, None, None), row(108, "twice the same"), row(108, "twice the same"),
             row(109, "equal text"), row(110, "equal text"), row(-5, "negative id")]
    return rows


def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


WHITE = " \t\n\v\f\r"


def words_of(text):
    out, word = [], ""
    for c in text or "":
        if c in WHITE:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out + ([word] if word else [])
