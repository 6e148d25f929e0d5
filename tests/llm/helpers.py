"""Small document tables with awkward rows."""

from __future__ import annotations

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_of(spark, texts, first=0):
    """A documents table with the given texts; ids count up from ``first``."""
    rows = [(first + i, t, "en", "src0", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


AWKWARD = [
    None,
    "",
    " ",
    "a  b\n\n c\t\td  e f\x1cg",
    "It's they'll I'D we've ''s don't",
    "Straße ΟΔΟΣ İstanbul été ﬁn ½ ٣٤ 漢字かな 🙂👍🏽",
    "before <|endoftext|> after<|endoftext|>x <|startoftext|>",
    " lead and trail \n",
    "one two three four five six",
    "one two three four five six",
    "word " * 9000,
    "x" * 30_000,
]
