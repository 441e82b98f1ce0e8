"""Repeated lines and sentences removed by hashing normalised units over the whole table."""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import settle

# Units of fewer words stay: such lines recur by chance. A unit of so many characters is compared anyway.
LEAST_WORDS, LONG_CHARS = 5, 50

# Full-width marks end a sentence without a blank. A match begins at the first mark of a run, which keeps runs linear.
_END = re.compile(r"(?<![.!?])[.!?]+[ \t]+|[。！？｡]+[」』）]*[ \t\u3000]*")
_NO_MARKS = str.maketrans("", "", ".,;:!?\"'()[]。！？｡、，；：「」『』（）")
# Scripts without blanks between words (Thai to Khmer, kana, Han); two characters count as a word.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def _compared(tokens: list[str], least_words: int) -> bool:
    """Whether a unit is long enough, by words or by characters; one without any word is not."""
    if len(tokens) >= least_words:
        return True
    whole = "".join(tokens)
    return len(whole) >= LONG_CHARS or (not whole.isascii() and len(tokens) + len(_UNSPACED.findall(whole)) // 2 >= least_words)


def _units(text: str):
    """(start, end) of each line's sentences, in code points; line feeds belong to no unit."""
    at = 0
    for line in text.split("\n"):
        first = 0
        for mark in _END.finditer(line):
            yield at + first, at + mark.end()
            first = mark.end()
        if first < len(line):
            yield at + first, at + len(line)
        at += len(line) + 1


def _hashed(docs: DataFrame, id_col: str, text_col: str, least_words: int) -> DataFrame:
    def work(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                counts, own, units = [], [], []
                for text in part.column(1):
                    text = text.as_py() or ""
                    seen: set[bytes] = set()
                    n, again, first = 0, [], []
                    for start, end in _units(text):
                        n += 1
                        tokens = text[start:end].lower().translate(_NO_MARKS).split()
                        if not _compared(tokens, least_words):
                            continue
                        digest = xxhash.xxh3_128_digest(" ".join(tokens).encode())
                        if digest in seen:
                            again.append({"start": start, "end": end})
                        else:
                            seen.add(digest)
                            first.append({"digest": digest, "start": start, "end": end})
                    counts.append(n)
                    own.append(again)
                    units.append(first)
                span = [("start", pa.int64()), ("end", pa.int64())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(1), pa.array(counts, pa.int64()),
                        pa.array(own, pa.list_(pa.struct(span))),
                        pa.array(units, pa.list_(pa.struct([("digest", pa.binary()), *span]))),
                    ],
                    names=["doc_id", "text", "n_units", "own", "units"],
                )

    span = "array<struct<start:long,end:long>>"
    schema = f"doc_id long, text string, n_units long, own {span}, units array<struct<digest:binary,start:long,end:long>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(work, schema).withColumn("row", F.monotonically_increasing_id())


def drop_repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS
) -> DataFrame:
    """Per row: doc_id, n_units, removed (array of start, end, in code points of the original), kept.

    A unit is a sentence within a line (a line without sentence marks is one unit). Units of fewer than
    ``least_words`` words stay, unless they are long (``LONG_CHARS``); where a script has no blanks between
    words, two characters count as one. Units are compared
    in lower case, without punctuation, with single spaces. Of equal units over the whole table the one
    in the smallest id stays (then the earlier row, then the earlier place); all others are removed.
    ``kept`` is the text that is left, joined; with ``removed`` it gives the original offsets.

    Repeats inside a document are found in its own task and digests are combined before they are shuffled,
    so a line that half of all documents share is no burden. Null texts count as empty and are kept as
    null; empty ones have no unit. Null ids come first; repeated rows give one row each. Other columns are
    ignored.
    """
    rows = settle(_hashed(docs, id_col, text_col, least_words), "units")
    units = rows.select("row", "doc_id", F.explode("units").alias("u")).select("row", "doc_id", "u.*")
    rank = F.struct("doc_id", "row")
    first = units.groupBy("digest").agg(F.min(rank).alias("first"), F.count("*").alias("many")).filter("many > 1")
    later = units.join(first.select("digest", F.col("first.row").alias("keeper")), "digest").filter("row <> keeper")
    spans = later.groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("more"))
    found = rows.drop("units").join(spans, "row", "left")
    removed = F.array_sort(F.concat("own", F.coalesce("more", F.array().cast("array<struct<start:bigint,end:bigint>>"))))
    return found.select("doc_id", "n_units", removed.alias("removed"), _kept("text", removed).alias("kept"))


def _kept(text: str, removed):
    @F.pandas_udf("string")
    def cut(texts, spans):
        out = []
        for text, gaps in zip(texts, spans, strict=True):
            if text is None:
                out.append(None)
                continue
            at, parts = 0, []
            for gap in gaps:
                parts.append(text[at : gap["start"]])
                at = gap["end"]
            out.append("".join([*parts, text[at:]]))
        return type(texts)(out, dtype=object)

    return cut(text, removed)
