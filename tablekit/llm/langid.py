"""Language identification with language-bitmask n-gram filters.

One Bloom filter per language, stored bit-sliced: row ``r`` of the table is a
bitmask of the languages whose filter has bit ``r`` set, in one column for each
``WORD`` languages.  The AND of an
n-gram's ``HASHES`` rows is the set of all languages that contain it.  A
document counts, for each language, how many of its n-grams have the
language's bit; shares are corrected by the filters' false-positive rates and
the largest one decides.

The filters hold each language's most typical byte n-grams, learned on a
bounded sample: about ``SAMPLE_PER_LANGUAGE`` documents a language, chosen by
hash, of texts over ``SAMPLE_CHARS`` characters an excerpt.

Edge cases: NULL texts and texts without a letter are ``und`` with score 0; so
is every text when nothing can be learned; repeated rows are judged one by
one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm.common import crc32_of_id, excerpt, shipped, table
from tablekit.llm.words import mix64, pieces

GRAM = 5                              # bytes
HASHES = 3
ROW_BITS = 18                         # rows of the bit-sliced table: 2 ** ROW_BITS
GRAMS_PER_LANGUAGE = 30_000
RELATIVE_RATE = 0.25                  # of the highest rate that any language has for the n-gram
SAMPLE_PER_LANGUAGE = 400
SAMPLE_TEXTS = 26_000                 # of all languages; with more than 65 each has an equal part, LEAST_TEXTS at least
LEAST_TEXTS = 20
SAMPLE_CHARS = 20_000
LEAST_SHARE = 0.25                    # corrected share that a text in a learned language exceeds
WORD = 64                             # languages in a column of the table
UNKNOWN = "und"
_U = np.uint64


def _folding() -> np.ndarray:
    """ASCII letters to lower case, other ASCII to a space; bytes of longer characters stay."""
    lut = np.arange(256, dtype=np.uint8)
    lut[:128] = 32
    lut[97:123] = np.arange(97, 123)
    lut[65:91] = np.arange(97, 123)
    return lut


FOLD = _folding()


def gram_keys(buf: np.ndarray, size: int) -> np.ndarray:
    """The GRAM bytes from every position on as one integer (``buf`` folded, with spare bytes)."""
    eights = np.ndarray(shape=(size,), dtype="<u8", buffer=buf, strides=(1,))
    return eights & _U((1 << (8 * GRAM)) - 1)


def row_indices(keys: np.ndarray) -> list[np.ndarray]:
    """The rows of the table that a key's HASHES hash functions give."""
    h = mix64(keys)
    return [((h >> _U(k * ROW_BITS)) & _U((1 << ROW_BITS) - 1)).astype(np.int32) for k in range(HASHES)]


@dataclass(frozen=True)
class LanguageFilters:
    languages: tuple[str, ...]
    tables: tuple[np.ndarray, ...]    # for each WORD languages their bitmask, one a row
    false_rates: tuple[float, ...]

    def masks(self, keys: np.ndarray, column: int = 0) -> np.ndarray:
        """For every n-gram the bitmask of the languages of a column that contain it."""
        return self._masks(row_indices(keys), column)

    def _masks(self, rows: list[np.ndarray], column: int) -> np.ndarray:
        table = self.tables[column]
        out = table[rows[0]]
        for r in rows[1:]:
            out &= table[r]
        return out

    def hits(self, keys: np.ndarray, inside: np.ndarray) -> Iterator[np.ndarray]:
        """For each language in turn, whether it contains the n-grams (those not ``inside``: no)."""
        rows = row_indices(keys)
        for column, table in enumerate(self.tables):
            masks = self._masks(rows, column)
            masks[~inside] = 0
            for bit in range(min(WORD, len(self.languages) - column * WORD)):
                yield (masks >> table.dtype.type(bit)) & table.dtype.type(1)


def learn(texts: list[str], langs: list[str]) -> LanguageFilters | None:
    """Filters from labelled texts; None without any."""
    by_lang: dict[str, list[str]] = {}
    for t, x in zip(texts, langs):
        by_lang.setdefault(x, []).append(t)
    names = sorted(by_lang)
    found = []
    for lang in names:
        raw = "\n".join(by_lang[lang]).encode()
        buf = np.zeros(len(raw) + 8, np.uint8)
        buf[:len(raw)] = FOLD[np.frombuffer(raw, np.uint8)]
        keys, counts = np.unique(gram_keys(buf, max(0, len(raw) - GRAM + 1)), return_counts=True)
        found.append((keys, counts / max(1, counts.sum())))
    if not names:
        return None
    every = np.unique(np.concatenate([k for k, _ in found]))
    top = np.zeros(len(every))
    for k, r in found:
        at = np.searchsorted(every, k)
        top[at] = np.maximum(top[at], r)
    tables, fill = [], []
    for i, (k, r) in enumerate(found):
        if i % WORD == 0:
            left = len(names) - i
            dtype = np.uint8 if left <= 8 else np.uint16 if left <= 16 else np.uint32 if left <= 32 else _U
            tables.append(np.zeros(1 << ROW_BITS, dtype))
        bits, bit = tables[-1], tables[-1].dtype.type(i % WORD)
        one = bits.dtype.type(1)
        typical = np.flatnonzero(r >= RELATIVE_RATE * top[np.searchsorted(every, k)])
        typical = typical[np.lexsort((k[typical], -r[typical]))][:GRAMS_PER_LANGUAGE]
        for rows in row_indices(k[typical]):
            bits[rows] |= one << bit
        fill.append(float(((bits >> bit) & one).mean()) ** HASHES)
    return LanguageFilters(tuple(names), tuple(tables), tuple(fill))


def learned_filters(docs: DataFrame) -> LanguageFilters | None:
    """Learn from ``docs(doc_id, text, lang)``: a sample by hash, bounded for every language."""
    usable = docs.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        "lang", excerpt(SAMPLE_CHARS).alias("text"), F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1_000_000)).alias("h"))
    sizes = usable.groupBy("lang").count().collect()
    if not sizes:
        return None
    each = min(SAMPLE_PER_LANGUAGE, max(LEAST_TEXTS, SAMPLE_TEXTS // len(sizes)))
    cuts = docs.sparkSession.createDataFrame(
        [(r["lang"], int(1_000_000 * min(1.0, each / r["count"])) + 1) for r in sizes],
        "lang string, cut long")
    rows = (usable.join(F.broadcast(cuts), "lang").filter("h < cut").select("lang", "text")
            .limit(2 * each * (len(sizes) + 1)).collect())
    return learn([r["text"] for r in rows], [r["lang"] for r in rows])


def has_letter(text: bytes) -> bool:
    return any(c.isalpha() for c in text.decode("utf-8", "replace"))


def predict(docs: DataFrame, model: LanguageFilters | None, keep: list[str],
            names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``docs`` with the language and its score, from ``text`` alone.

    A third name adds whether the text is in a learned language at all: its best
    corrected share exceeds LEAST_SHARE, or it has a letter but no whole n-gram to judge by.
    """
    schema = docs.select(*keep).schema.add(names[0], "string").add(names[1], "double")
    if len(names) > 2:
        schema = schema.add(names[2], "boolean")
    out_names = [*keep, *names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs = np.array(list(model.languages) if model else [UNKNOWN], dtype=object)
        for b in batches:
            for row, buf, offs in pieces(b.column(len(keep))):
                n, size = len(offs) - 1, int(offs[-1])
                shares = np.zeros((len(langs), n))
                if model:
                    folded = np.zeros_like(buf)
                    folded[:size] = FOLD[buf[:size]]
                    inside = np.ones(size, bool)
                    for k in range(1, GRAM):           # windows that reach into the next document
                        inside[np.maximum(offs[1:] - k, 0)] = False
                    total = np.maximum(np.diff(offs) - GRAM + 1, 1)
                    bits = model.hits(gram_keys(folded, size), inside[:size])
                    for i, (false_rate, has) in enumerate(zip(model.false_rates, bits)):
                        sums = np.concatenate(([0], np.cumsum(has, dtype=np.int64)))
                        hits = (sums[offs[1:]] - sums[offs[:-1]]) / total
                        shares[i] = np.maximum(0.0, (hits - false_rate) / (1 - false_rate))
                best = shares.argmax(axis=0)
                summed = shares.sum(axis=0)
                score = np.where(summed > 0, shares.max(axis=0) / np.where(summed > 0, summed, 1), 0.0)
                ascii_letter = ((buf | 32) >= 97) & ((buf | 32) <= 122)
                letters = np.concatenate(([0], np.cumsum(ascii_letter[:size], dtype=np.int64)))
                known = letters[offs[1:]] > letters[offs[:-1]]
                for i in np.flatnonzero(~known):
                    known[i] = has_letter(buf[offs[i]:offs[i + 1]].tobytes())
                known &= model is not None
                pred = np.where(known, langs[best], UNKNOWN)
                own = [b.column(i).slice(row, n) for i in range(len(keep))]
                learned = known & ((shares.max(axis=0) > LEAST_SHARE) | (np.diff(offs) < GRAM))
                found = [pa.array(pred, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(learned)]
                yield pa.RecordBatch.from_arrays([*own, *found[:len(names)]], names=out_names)

    shipped(docs.sparkSession)
    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def held_out() -> Column:
    return crc32_of_id() % 3 == 1


def identified(docs: DataFrame, keep: list[str], names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """Learn from the rows that are not held out and predict all of ``docs``."""
    return predict(docs, learned_filters(docs.filter(~held_out())), keep, names)


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of all documents."""
    docs = table(spark, sf_dir, "documents").withColumn("held_out", held_out())
    return identified(docs, ["doc_id", "held_out"])
