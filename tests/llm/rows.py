"""Rows shared by the tests of this folder."""

from pyspark.sql import types as T

# Names that the operators use inside or return, as further columns of their inputs.
CLASHING = ("score", "kept", "n_words", "n_tokens", "digest", "node", "family", "band", "block", "shard", "place", "piece",
            "length", "start", "sequence_id", "host", "rule", "values", "run", "rank", "toxic", "predicted", "accepted",
            "judged_id", "row", "component_id", "lang_pred", "whole", "words", "lines", "url_key")
DOCUMENTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

LONG = " ".join(f"word{i % 997}x{i % 13}" for i in range(60_000))
AWKWARD = [
    (1, None, "en", "a.example", None), (2, "", "en", "a.example", 0), (3, " \n\t ", None, None, 3), (None, "some text without an id", "en", None, 1),
    (4, "The MIT License and the Apache License.", "en", "a.example", 40), (5, LONG, "en", "b.example", len(LONG)),
    (6, "one two three four five six seven", None, "b.example", None), (6, "one two three four five six seven", None, "b.example", None),
    (7, "one two three four five six seven", "en", "b.example", 1), (8, "🙂 ÉTÉ straße 中文 \x00 é\u0085x", "fr", "c.example", 5),
    (9, "a" * 5000, "de", None, 5000), (10, "1234 !!! 5678", "en", "c.example", 13), (None, None, None, None, None),
]
