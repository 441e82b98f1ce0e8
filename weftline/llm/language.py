"""Language of texts by cross-parsing against automata of labelled text."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.llm.text import SLICE_BYTES
from weftline.session import settle

# Labelled text that an automaton is built from, per language: at most this many documents, each with
# this many characters from a place that its id picks, and this many characters in all.
SAMPLE_DOCS, SAMPLE_PART, SAMPLE_CHARS = 400, 400, 60_000
# Languages that are sampled, or parsed with, at once: each costs at most 4 MB in a task. More take more passes.
LANGUAGES_AT_ONCE = 64
# Characters that are parsed without a break; a phrase ends there for every language alike.
STRETCH = 1024
UNKNOWN = "und"


def sample(labelled: DataFrame, id_col: str, text_col: str, lang_col: str) -> dict[str, str]:
    """A bounded sample of labelled text per language, the same for the same rows in any order."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    rows = rows.filter("lang is not null and length(text) > 0").withColumn("place", F.xxhash64(F.col("id").cast("string")))
    counts = sorted((r["lang"], r["count"]) for r in rows.groupBy("lang").count().collect())
    out = {}
    for k in range(0, len(counts), LANGUAGES_AT_ONCE):
        out |= _sample_some(rows, dict(counts[k : k + LANGUAGES_AT_ONCE]))
    return out


def _sample_some(rows: DataFrame, counts: dict[str, int]) -> dict[str, str]:
    # Ids are hashed evenly, so about four times the sample passes; the smallest hashes of it are taken.
    share = F.create_map(*(x for k, n in counts.items() for x in (F.lit(k), F.lit(min(1.0, 4 * SAMPLE_DOCS / n)))))
    near = rows.filter(F.pmod("place", F.lit(1 << 32)) < F.try_element_at(share, F.col("lang")) * (1 << 32))
    start = F.pmod(F.col("place"), F.greatest(F.length("text") - SAMPLE_PART, F.lit(1))).cast("int") + 1
    near = near.select("lang", "place", F.col("text").substr(start, F.lit(SAMPLE_PART)).alias("part"))
    found: dict[str, list] = {}
    for r in near.collect():  # about 4 * SAMPLE_DOCS parts per language
        found.setdefault(r["lang"], []).append((r["place"] % (1 << 32), r["part"]))
    return {k: " ".join(p for _, p in sorted(v)[:SAMPLE_DOCS])[:SAMPLE_CHARS] for k, v in sorted(found.items())}


def letters(text: str) -> str:
    """Letters in lower case; runs of anything else become one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def automaton(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The suffix automaton of a text of character classes: its moves as (from, class, to), and how many states it has.

    A text of n characters gives fewer than 2 n states and 3 n moves, whatever its alphabet.
    """
    moves: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for code in codes.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and code not in moves[p]:
            moves[p][code] = new
            p = link[p]
        if p >= 0:
            q = moves[p][code]
            if length[p] + 1 == length[q]:
                link[new] = q
            else:
                twin = len(moves)
                moves.append(dict(moves[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and moves[p].get(code) == q:
                    moves[p][code] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    many = np.fromiter((len(m) for m in moves), np.int64, len(moves))
    total = int(many.sum())
    by = np.fromiter((c for m in moves for c in m), np.int64, total)
    to = np.fromiter((t for m in moves for t in m.values()), np.int64, total)
    return np.repeat(np.arange(len(moves)), many), by, to, len(moves)


def overlaid(source: np.ndarray, by: np.ndarray, to: np.ndarray, states: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sparse rows laid over each other in one array: the offset of each state, and cells of (state, goal).

    The move of a state by a class is the cell at offset + class, if that cell names the state. States of several moves
    are placed first, where all their cells are free; those of one move fill the gaps, so few cells stay empty.
    """
    order = np.argsort(source, kind="stable")
    source, by, to = source[order], by[order], to[order]
    many = np.bincount(source, minlength=states)
    first = np.cumsum(many) - many
    several = np.flatnonzero(many > 1)
    offsets = np.zeros(states, dtype=np.int32)
    used, low, all_by = bytearray(2 * width), width, by.tolist()
    for state in several[np.argsort(-many[several], kind="stable")].tolist():
        classes = all_by[first[state] : first[state] + many[state]]
        at, tries, lead = low, 0, classes[0]
        while True:
            at = used.find(0, at)
            if at < 0 or at + width >= len(used):
                used.extend(bytes(len(used)))
                at = max(at, low)
                continue
            if not any(used[at - lead + c] for c in classes):
                break
            at, tries = at + 1, tries + 1
        for c in classes:
            used[at - lead + c] = 1
        offsets[state] = at - lead
        if tries > 16:
            low = at
    single = np.flatnonzero(many == 1)
    gaps = np.flatnonzero(np.frombuffer(used, np.uint8)[width:] == 0)[: len(single)] + width
    gaps = np.concatenate([gaps, len(used) + np.arange(len(single) - len(gaps))])
    offsets[single] = gaps - np.array(all_by, dtype=np.int64)[first[single]]
    cells = np.full((int(offsets.max(initial=0)) + width, 2), -1, dtype=np.int32)
    places = offsets[source] + by
    cells[places, 0], cells[places, 1] = to, source
    return offsets, cells.view(np.int64).ravel()


class Parser:
    """Automata of all languages and the phrases per character that each needs for a text.

    The moves of all languages lie in one array (``overlaid``) of eight bytes a move and four a state: at most 2 MB
    for a language of ``SAMPLE_CHARS``, however many signs it has. A move that is missing goes to the state that
    the character reaches from the start, and a phrase ends. Class 0 is any letter that no text has.
    """

    def __init__(self, texts: dict[str, str]):
        texts = {k: letters(v) for k, v in texts.items()}
        texts = {k: v for k, v in texts.items() if v.strip()}
        signs = sorted(set("".join(texts.values())) | {" "})
        classes = {c: i + 1 for i, c in enumerate(signs)}
        self.languages, self.blank, self.width = sorted(texts), classes[" "], len(signs) + 1
        self.codes = np.full(0x110000, self.blank, dtype=np.uint8 if len(signs) < 254 else np.uint16 if len(signs) < 65534 else np.uint32)
        self.codes[np.array([chr(c).isalpha() for c in range(0x110000)])] = 0
        for c, i in classes.items():
            self.codes[ord(c)] = i
            if len(c.upper()) == 1 and c.upper().lower() == c:
                self.codes[ord(c.upper())] = i
        moves, states = [(np.empty(0, np.int64),) * 3], 0
        # Per language the move of each class from the start; without one, a state of its own that has no moves.
        self.starts = np.zeros(len(texts), dtype=np.int32)
        self.roots = np.zeros((len(texts), self.width), dtype=np.int32)
        for k, name in enumerate(self.languages):
            source, by, to, n = automaton(np.array([classes[c] for c in texts[name]]))
            moves.append((source + states, by, to + states))
            self.starts[k] = states
            self.roots[k] = states + n
            self.roots[k, by[source == 0]] = to[source == 0] + states
            states += n + 1
        self.offsets, self.cells = overlaid(*(np.concatenate(x) for x in zip(*moves, strict=True)), states, self.width)

    def arrays(self) -> dict:
        """All that makes up the parser, in plain values that can be broadcast."""
        return dict(self.__dict__)

    @classmethod
    def of(cls, arrays: dict) -> Parser:
        made = cls.__new__(cls)
        made.__dict__.update(arrays)
        return made

    def moved(self, states: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The next state of each language (row) and place (column), and whether the move was there."""
        cells = self.cells[self.offsets[states] + codes]
        there = cells >> 32 == states
        return np.where(there, cells & 0xFFFFFFFF, self.roots[:, codes]), there

    def encode(self, text: str) -> np.ndarray:
        raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = self.codes[raw]
        blank = codes == self.blank
        keep = ~blank
        keep[1:] |= ~blank[:-1]
        codes = codes[keep]
        return codes[1:] if len(codes) and codes[0] == self.blank else codes

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each language needs for each text, in numpy over all stretches at once."""
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        parts = -(-lengths // STRETCH)
        doc = np.repeat(np.arange(len(texts)), parts)
        within = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        starts = np.repeat(np.cumsum(lengths) - lengths, parts) + within * STRETCH
        sizes = np.minimum(STRETCH, np.repeat(lengths, parts) - within * STRETCH)
        order = np.argsort(-sizes, kind="stable")
        doc, starts, sizes = doc[order], starts[order], sizes[order]
        flat = np.concatenate(texts) if texts else np.empty(0, np.uint8)
        counts = np.ones((len(self.languages), len(doc)), dtype=np.int64)
        states = np.repeat(self.starts[:, None], len(doc), axis=1)
        active = np.searchsorted(-sizes, -np.arange(STRETCH), side="left")
        for j in range(int(sizes[0]) if len(sizes) else 0):
            n = active[j]
            codes = flat[starts[:n] + j]
            states[:, :n], there = self.moved(states[:, :n], codes)
            if j:
                counts[:, :n] += ~there
        out = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(doc, weights=counts[k], minlength=len(texts)).astype(np.int64)
        return out

    def best(self, texts: list[str]) -> list[tuple[str, float, float]]:
        """(language, phrases per letter, those of the next language or infinity) of each text."""
        codes = [self.encode(t) for t in texts]
        letters_ = np.array([int((c != self.blank).sum()) for c in codes], dtype=np.int64)
        if not self.languages:
            return [(UNKNOWN, 0.0, np.inf)] * len(texts)
        needed = self.phrases(codes) / np.maximum(letters_, 1)[:, None]
        out = []
        for i, row in enumerate(needed):
            if not letters_[i]:
                out.append((UNKNOWN, 0.0, np.inf))
                continue
            best = int(np.argmin(row))
            out.append((self.languages[best], float(row[best]), float(np.delete(row, best).min(initial=np.inf))))
        return out


def _better(old: tuple[str, float, float], new: tuple[str, float, float]) -> tuple[str, float, float]:
    """The best and the next of two blocks of languages; the old block has the smaller names."""
    if not (old[1] and new[1]):  # without letters, or a block without any text
        return new if new[1] else old
    first, second = (new, old) if new[1] < old[1] else (old, new)
    return first[0], first[1], min(first[2], second[1])


def identify(docs: DataFrame, texts: dict[str, str], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score and lang_rate, from the texts of each language.

    Each text is read as phrases, each the longest that occurs in a language's text; the language that
    needs the fewest phrases per letter wins, ties go to the smaller name. ``lang_score`` is the share of
    phrases that the best language saves over the next (0 to 1), ``lang_rate`` its phrases per letter.
    Null texts and texts without letters give ``und``, 0 and 0. Rows and other columns stay as they are;
    columns of these three names are replaced. Beyond ``LANGUAGES_AT_ONCE`` languages, further blocks of
    them take a pass each over the rows, which are written in between.
    """
    docs = docs.drop(*_NEW)
    names = sorted(k for k, v in texts.items() if letters(v))
    blocks = [names[k : k + LANGUAGES_AT_ONCE] for k in range(0, len(names), LANGUAGES_AT_ONCE)] or [[]]
    for k, block in enumerate(blocks):
        docs = _pass(docs if k == 0 else settle(docs, "languages"), {x: texts[x] for x in block}, text_col, k > 0)
    return docs


_NEW = ("lang_pred", "lang_score", "lang_rate")


def _pass(docs: DataFrame, texts: dict[str, str], text_col: str, again: bool) -> DataFrame:
    """The three columns from one block of languages, or from it and the blocks before."""
    plain = docs.drop(*_NEW)
    at = plain.columns.index(text_col)
    wide = len(plain.columns)
    # Built once, here; a task only loads the arrays.
    given = docs.sparkSession.sparkContext.broadcast(Parser(texts).arrays())

    def work(batches):
        parser = Parser.of(given.value)
        for batch in batches:
            first = held = 0
            rows: list[str] = []

            def out(first, rows, batch=batch):
                part = batch.slice(first, len(rows))
                found = parser.best(rows)
                if again:
                    known = [part.column(wide + k).to_pylist() for k in range(3)]
                    # The next rate follows from the score: score = 1 - rate / next.
                    old = [(x, r, r / (1 - s) if s < 1 else np.inf) for x, s, r in zip(*known, strict=True)]
                    found = [_better(a, b) for a, b in zip(old, found, strict=True)]
                langs = [x for x, _, _ in found]
                scores = [1 - r / n if r else 0.0 for _, r, n in found]
                rates = [r for _, r, _ in found]
                return pa.RecordBatch.from_arrays(
                    [*part.columns[:wide], pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rates, pa.float64())],
                    names=[*part.schema.names[:wide], *_NEW],
                )

            for i, text in enumerate(batch.column(at)):
                text = text.as_py() or ""
                rows.append(text)
                held += len(text)
                if held >= 4 * SLICE_BYTES:
                    yield out(first, rows)
                    first, held, rows = i + 1, 0, []
            if rows:
                yield out(first, rows)

    fields = [T.StructField(_NEW[0], T.StringType()), *(T.StructField(c, T.DoubleType()) for c in _NEW[1:])]
    return docs.mapInArrow(work, T.StructType([*plain.schema.fields, *fields]))


def held_out(id_col: str = "doc_id"):
    """Whether a document is kept out of learning: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, str]:
    """The sample of the documents that are not held out."""
    return sample(docs.filter(~held_out(id_col)), id_col, text_col, lang_col)
