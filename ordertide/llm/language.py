"""Language identification by prediction by partial matching (PPM).

Per language a byte context tree of up to three bytes counts which byte followed
which context. A text's code length under a language is the sum over its bytes of
-log2 p, with escapes to shorter contexts by method C: a context seen n times with
d different successors gives its successor s the probability count(s) / (n + d)
and the escape d / (n + d); below the empty context every byte has 1 / 256. The
counts are frozen before any text is scored. The shortest code wins.

For speed each worker unrolls the trees into one table: a row per context that
any language knows, a column per byte that training has seen (all others share
one), so a text is scored by two table lookups per byte. The table is bounded by
the training sample, at most ``sample_rows`` texts of a language.

A text that is null or has no letter is ``und`` with score 0; so is every text
if nothing was learned. The score is the winner's share of 2**-length among the
languages. Ties go to the language that comes first by name. Languages are
learned from rows with non-null text and label, repeated texts once, of long ones a
piece; all texts are scored whole. No documents give no rows. Only the named columns
are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import store, text

#: Distinct training texts of a language at most; the sample is by a hash of the text.
SAMPLE_ROWS = 300
#: Bytes of one training text at most; of a longer one a piece is in the sample.
SAMPLE_BYTES = 20_000
UNKNOWN = "und"
ORDER = 3
_LETTER = regex.compile(r"\p{L}")


def training_sample(
    docs: DataFrame, learn: Column, rows: int = SAMPLE_ROWS, label: str = "lang", text_column: str = "text"
) -> DataFrame:
    """(lang, text): per language the distinct texts with the smallest hashes, of long ones a piece."""
    chosen = docs.where(learn).select(F.col(label).alias("lang"), F.col(text_column).alias("text"))
    chosen = chosen.where(F.col("lang").isNotNull() & (F.octet_length("text") > 0))
    chosen = chosen.withColumn("_h", F.xxhash64("text"))
    # Hashes below a language's share of their range: about four times the rows wanted, however many there are.
    counts = chosen.groupBy("lang").agg(F.approx_count_distinct("_h").alias("_n"))
    share = F.least(F.lit(1.0), F.lit(4.0 * rows) / F.greatest("_n", F.lit(1)))
    # One row per language, as the model has one tree per language.
    few = chosen.join(F.broadcast(counts), "lang").where(F.col("_h").cast("double") <= (2 * share - 1) * float(1 << 63))
    few = few.withColumn("text", store.piece(F.col("text"), SAMPLE_BYTES))
    distinct = few.groupBy("lang", "_h").agg(F.min("text").alias("text"))
    ranked = Window.partitionBy("lang").orderBy("_h")
    return distinct.withColumn("_n", F.row_number().over(ranked)).where(F.col("_n") <= rows).select("lang", "text")


class Model:
    """Context counts of each language: keys of (context, byte) by order, with counts."""

    def __init__(self, texts: dict[str, list[bytes]]):
        self.languages = sorted(texts)
        seen = np.zeros(256, bool)
        for own in texts.values():
            for x in own:
                seen[np.frombuffer(x, np.uint8)] = True
        #: Byte to symbol; 0 stands for every byte that training lacks.
        self.symbols = np.where(seen, np.cumsum(seen), 0).astype(np.uint16)
        self.size = int(seen.sum()) + 1
        self.counts = []
        for language in self.languages:
            orders = []
            for order in range(ORDER + 1):
                keys = []
                for x in texts[language]:
                    s = self.symbols[np.frombuffer(x, np.uint8)].astype(np.int64)
                    if len(s) > order:
                        key = np.zeros(len(s) - order, np.int64)
                        for j in range(order + 1):
                            key = key * self.size + s[j : len(s) - order + j]
                        keys.append(key)
                orders.append(np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_counts=True))
            self.counts.append(orders)


class Table:
    """The model unrolled: ``state`` by the last three symbols, ``bits[state, symbol]`` per language."""

    def __init__(self, model: Model):
        size, languages = model.size, len(model.languages)
        self.model = model
        contexts = [
            np.unique(np.concatenate([own[order][0] // size for own in model.counts] or [np.zeros(0, np.int64)]))
            for order in range(ORDER + 1)
        ]
        self.base = np.concatenate([[0], np.cumsum([len(c) for c in contexts])])
        self.bits = np.full((int(self.base[-1]) + 1, size, languages), 8.0, np.float32)
        #: State of every three symbols: the longest context of them that any language knows.
        self.state = np.zeros(size**ORDER, np.int32)
        all_contexts = np.arange(size**ORDER, dtype=np.int64)
        for order, own in enumerate(contexts):
            if not len(own):
                continue
            suffix = all_contexts % size**order
            at = np.minimum(np.searchsorted(own, suffix), len(own) - 1)
            known = own[at] == suffix
            self.state[known] = self.base[order] + at[known]
            rows = slice(int(self.base[order]), int(self.base[order + 1]))
            if order:
                shorter = contexts[order - 1]
                self.bits[rows] = self.bits[self.base[order - 1] + np.searchsorted(shorter, own % size ** (order - 1))]
            for k, counts in enumerate(model.counts):
                keys, n = counts[order]
                where = np.searchsorted(own, keys // size)
                total = np.bincount(where, n, len(own))
                different = np.bincount(where, minlength=len(own))
                escaped = np.log2(np.where(total > 0, (total + different) / np.maximum(different, 1), 1.0))
                self.bits[rows, :, k] += escaped[:, None].astype(np.float32)
                self.bits[self.base[order] + where, keys % size, k] = -np.log2(n / (total + different)[where])
        if not languages:
            self.bits = np.zeros((1, size, 0), np.float32)

    def lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of every row's bytes under every language; contexts stay within a row."""
        n, languages = len(offsets) - 1, len(self.model.languages)
        out = np.zeros((n, languages))
        if not len(data) or not languages:
            return out
        size = self.model.size
        s = self.model.symbols[data].astype(np.int32)
        context = np.zeros(len(s), np.int32)
        context[3:] = (s[:-3] * size + s[1:-2]) * size + s[2:-1]
        cost = self.bits.reshape(-1, languages)[self.state[context] * size + s]
        # The first bytes of a row have fewer bytes before them, so only shorter contexts.
        known = {
            order: np.unique(np.concatenate([own[order][0] // size for own in self.model.counts])) for order in range(ORDER)
        }
        begins = offsets[:-1]
        for order in range(ORDER):
            at = begins + order
            rows = at < offsets[1:]
            at = at[rows]
            if not len(at):
                continue
            state = np.full(len(at), self.base[0])
            for shorter in range(order + 1):
                context_key = np.zeros(len(at), np.int64)
                for j in range(shorter, 0, -1):
                    context_key = context_key * size + s[at - j]
                own = known[shorter]
                place = np.minimum(np.searchsorted(own, context_key), len(own) - 1)
                state = np.where(own[place] == context_key, self.base[shorter] + place, state)
            cost[at] = self.bits[state, s[at]]
        filled = np.flatnonzero(np.diff(offsets) > 0)
        out[filled] = np.add.reduceat(cost, begins[filled], axis=0, dtype=np.float64)
        return out


def learn(sample: DataFrame) -> Model:
    """The model of a bounded sample (see :func:`training_sample`)."""
    texts: dict[str, list[bytes]] = {}
    for row in sample.select("lang", "text").collect():
        texts.setdefault(row["lang"], []).append(row["text"].encode())
    return Model(texts)


def identify(docs: DataFrame, model: Model, text_column: str = "text", columns: tuple[str, ...] = ()) -> DataFrame:
    """``columns`` of every document with lang_pred, score and bits_per_byte of the winner."""
    store.ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = ", ".join(f"`{name}` {kind}" for name, kind in docs.select(*columns).dtypes)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(shared.value)
        languages = np.array([*table.model.languages, UNKNOWN], object)
        for batch in batches:
            names, scores, rates = [], [], []
            for first, last, data, offsets in text.slices(batch.column(0)):
                bits = table.lengths(data, offsets)
                letters = np.array([bool(_LETTER.search(x or "")) for x in batch.column(0).slice(first, last - first).to_pylist()])
                if bits.shape[1]:
                    best = bits.argmin(axis=1)
                    least = bits.min(axis=1)
                    share = 1 / np.exp2(np.minimum(0, least[:, None] - bits)).sum(axis=1)
                else:
                    best, least, share = np.zeros(len(bits), int), np.zeros(len(bits)), np.zeros(len(bits))
                best = np.where(letters, best, len(languages) - 1)
                names += languages[best].tolist()
                scores.append(np.where(best == len(languages) - 1, 0.0, share))
                rates.append(least / np.maximum(1, np.diff(offsets)))
            found = [pa.array(names, pa.string()), *(pa.array(np.concatenate(x or [np.zeros(0)])) for x in (scores, rates))]
            kept = [batch.column(k + 1) for k in range(len(columns))]
            yield pa.RecordBatch.from_arrays([*kept, *found], names=[*columns, "lang_pred", "score", "bits_per_byte"])

    schema = f"{fields}{', ' if fields else ''}lang_pred string, score double, bits_per_byte double"
    return docs.select(F.col(text_column).alias("_text"), *columns).mapInArrow(score, schema)
