"""Personal data by patterns, and further identifiers by bootstrapped contexts."""

from __future__ import annotations

import re
from hashlib import sha256

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftline.session import settle

KINDS = ("email", "ip", "card", "phone", "id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin at the first digit of a run, which keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(r"\S+")
_EDGES = "\"'`.,;:!?()[]{}<>"
# Key material: long runs of letters and digits of many kinds. Numbers and dotted quads are judged by their own kinds.
_KEY = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_JUDGED = re.compile(r"[0-9-]{14,}|[0-9]+(?:\.[0-9]+){3}")
# The words before an identifier that make its context: this far back, in characters.
_BEFORE = 48

_SPAN = "struct<start:long,kind:int,end:long>"
_CUE = "struct<start:long,end:long,instance:long,patterns:array<long>,seed:boolean>"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every email, ip, card and phone; per kind leftmost and not overlapping."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            end = domain.end()
            found.append((start, 0, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", max(at + 1, end))
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def _is_key(string: str) -> bool:
    digits = sum(c.isdigit() for c in string)
    return bool(_KEY.fullmatch(string)) and digits >= 4 and len(string) - digits >= 4 and len(set(string)) >= 10


def _contexts(text: str, spans: list[tuple[int, int, int]]):
    """Identifier-shaped strings with the lexical patterns before them: (start, end, instance, patterns, seed).

    Such a string is a base span, or a run without white space that holds two digits and six characters
    after a ``name=`` prefix and outer punctuation are taken off; numbers of 14 digits or more and dotted quads that
    are no base spans have failed the check of their kind and are none. Base spans and key material are seeds. Its patterns are the word before it,
    and the two words before it, in lower case; a ``name=`` prefix counts as the word before it.
    """
    items = [(a, b) for a, _, b in spans]
    taken = sorted(items)
    k = 0
    for m in _TOKEN.finditer(text):
        if not _DIGIT.search(text, m.start(), m.end()):
            continue
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k < len(taken) and taken[k][0] < m.end():
            continue
        token, start = m.group(), m.start()
        cut = max(token.find("="), token.find(":")) + 1
        start, token = start + cut, token[cut:]
        close = token.find(token[0], 1) if token[:1] in ('"', "'") else -1
        if close > 0:  # what is quoted, without what is glued to the quotes
            token = token[: close + 1]
        inner = token.strip(_EDGES)
        start += len(token) - len(token.lstrip(_EDGES))
        if len(inner) >= 6 and sum(c.isdigit() for c in inner) >= 2 and not _JUDGED.fullmatch(inner):
            items.append((start, start + len(inner)))
    for place, (start, end) in enumerate(items):
        words = text[max(0, start - _BEFORE) : start].lower().rstrip(_EDGES + " \t\r\n=").split()
        sign = "=" if "=" in text[max(0, start - 3) : start] else ""
        patterns = [" ".join(words[-n:]) + sign for n in (1, 2) if len(words) >= n]
        code = xxhash.xxh3_64_intdigest(text[start:end].encode()) >> 1
        seed = place < len(spans) or _is_key(text[start:end])
        yield start, end, code, [xxhash.xxh3_64_intdigest(p.encode()) >> 1 for p in patterns], seed


def _scan(docs: DataFrame, text_col: str) -> DataFrame:
    from pyspark.sql import types as T

    extra = T.StructType(docs.schema.fields)
    at = docs.columns.index(text_col)

    def work(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                spans, cues = [], []
                for text in part.column(at):
                    text = text.as_py() or ""
                    found = base_spans(text)
                    spans.append([{"start": a, "kind": k, "end": b} for a, k, b in found])
                    near = _contexts(text, found) if _DIGIT.search(text) or found else ()
                    cues.append([{"start": a, "end": b, "instance": c, "patterns": p, "seed": s} for a, b, c, p, s in near])
                span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
                cue = pa.struct(
                    [
                        *(("start", pa.int64()), ("end", pa.int64()), ("instance", pa.int64())),
                        *(("patterns", pa.list_(pa.int64())), ("seed", pa.bool_())),
                    ]
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(spans, pa.list_(span)), pa.array(cues, pa.list_(cue))],
                    names=[*part.schema.names, "base__", "cues__"],
                )

    found = T.StructType.fromDDL(f"base__ array<{_SPAN}>, cues__ array<{_CUE}>")
    return docs.mapInArrow(work, T.StructType([*extra.fields, *found.fields]))


def find_private(
    docs: DataFrame,
    text_col: str = "text",
    rounds: int = 2,
    least_confidence: float = 0.8,
    least_support: int = 3,
) -> DataFrame:
    """``docs`` with ``base`` and ``spans``: arrays of (start, kind, end) in code points, by start.

    ``base`` holds what the fixed patterns find. These strings, and key material (20 letters and digits or more, of
    ten kinds), are the seeds of a graph between strings and the words before them. Key material is found only
    where a strong pattern introduces it. In each round a pattern's confidence is the mean score of the distinct
    strings it introduces (one more than there are in the denominator), and a string's score is that of
    its best pattern with enough support, 1 for seeds; here only seeds are support. Patterns that end at
    ``least_confidence`` with ``least_support`` distinct seeds are strong, and the strings that they introduce
    are found, with the best such confidence as score. Then, until none is new, each further pattern is strong
    whose found strings (seeds included) number ``least_support`` and whose confidence by these alone reaches
    ``least_confidence``; it keeps that confidence, so no pattern supports itself. Strong patterns add every
    identifier-shaped string that they introduce, as kind ``id``. Base spans always stay, and added ones do not
    overlap them.

    Null texts count as empty. All rows and columns stay as they are, whatever their names; a table's
    own ``base`` or ``spans`` is replaced.
    """
    docs = docs.drop("base", "spans")
    rows = settle(_scan(docs, text_col).withColumn("row__", F.monotonically_increasing_id()), "scanned")
    cues = rows.select("row__", "base__", F.explode("cues__").alias("c"))
    based = F.exists("base__", lambda s: s["start"] == F.col("c.start"))
    cues = cues.select("row__", "c.*", based.alias("based"))
    edges = cues.select("instance", "seed", F.explode("patterns").alias("pattern"))
    edges = settle(edges.groupBy("pattern", "instance").agg(F.max("seed").cast("double").alias("seed")), "edges")
    score = edges.groupBy("instance").agg(F.max("seed").alias("score"))
    for _ in range(rounds):
        known = edges.join(score, "instance").groupBy("pattern")
        patterns = known.agg((F.sum("score") / (F.count("*") + 1)).alias("confidence"), F.sum(F.col("score").cast("int")).alias("support"))
        patterns = settle(patterns.filter(F.col("support") >= least_support), "patterns")
        score = edges.join(patterns, "pattern", "left").groupBy("instance").agg(
            F.greatest(F.max("seed"), F.coalesce(F.max("confidence"), F.lit(0.0))).alias("score")
        )
    strong = patterns.filter(F.col("confidence") >= least_confidence).select("pattern", "confidence")
    strong = settle(strong, "strong")
    more = strong
    while not more.isEmpty():
        found = edges.join(strong, "pattern", "left").groupBy("instance").agg(
            F.greatest(F.max("seed"), F.coalesce(F.max("confidence"), F.lit(0.0))).alias("score")
        )
        found = found.filter(F.col("score") >= least_confidence)
        known = edges.join(found, "instance", "left").groupBy("pattern")
        more = known.agg((F.coalesce(F.sum("score"), F.lit(0.0)) / (F.count("*") + 1)).alias("confidence"), F.count("score").alias("support"))
        more = more.filter((F.col("support") >= least_support) & (F.col("confidence") >= least_confidence))
        more = settle(more.select("pattern", "confidence").join(strong, "pattern", "left_anti"), "more")
        strong = settle(strong.unionByName(more), "strong")
    strong = strong.select("pattern")
    new = cues.filter("not based").select("row__", "start", "end", F.explode("patterns").alias("pattern"))
    new = new.join(strong, "pattern").select("row__", "start", "end").distinct()
    kind = KINDS.index("id")
    added = new.groupBy("row__").agg(F.collect_list(F.struct("start", F.lit(kind).alias("kind"), "end")).alias("added__"))
    none = F.array().cast(f"array<{_SPAN}>")
    spans = F.array_sort(F.concat("base__", F.coalesce("added__", none)))
    return rows.join(added, "row__", "left").select(
        *(F.col(f"`{c}`") for c in docs.columns), F.col("base__").alias("base"), spans.alias("spans")
    )


def span_text(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    each = F.transform(
        spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(each, ",")


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row: counts of base spans by kind, the digest of their list, and the list of all spans."""

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(4)]
    return found.select(
        F.col(id_col).alias("doc_id"), *counts, F.sha2(span_text("base"), 256).alias("base_sha256"), span_text("spans").alias("spans")
    )


def base_digest(text: str) -> str:
    """The digest that ``report`` gives, for one text."""
    return sha256(",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in base_spans(text)).encode()).hexdigest()


def mask(found: DataFrame, text_col: str = "text") -> DataFrame:
    """The result of ``find_private`` with every span replaced by its kind in angle brackets.

    Overlapping spans are replaced together, by the kind of the first. Null texts stay null.
    """

    @F.pandas_udf("string")
    def masked(texts, spans):
        out = []
        for text, marks in zip(texts, spans, strict=True):
            if text is None:
                out.append(None)
                continue
            at, parts, end = 0, [], 0
            for m in marks:
                if m["start"] >= end:
                    parts += [text[at : m["start"]], f"<{KINDS[m['kind']]}>"]
                at = end = max(end, m["end"])
            out.append("".join([*parts, text[at:]]))
        return type(texts)(out, dtype=object)

    return found.withColumn(text_col, F.when(F.size("spans") > 0, masked(text_col, "spans")).otherwise(F.col(text_col)))
