"""Language identification by interpolated Kneser-Ney character models.

For every language, n-grams of up to ``ORDER`` characters of the training texts are counted
by Spark; the highest order keeps its counts, the lower ones how many different characters
go before them. Probabilities and back-off weights are stored in arrays sorted by n-gram
hash and looked up by binary search. A text's language is the one with the lowest cross-entropy
per character; it is rejected if that is far above what texts held back from the counts
have, given their lengths.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructType
from pyspark.sql.window import Window

from lullcast.llm.common import sampled
from lullcast.llm.sharding import shuffle_order
from lullcast.workspace import materialize

ORDER = 4
#: Models are fitted on so many texts of each language at most, those first in hash order;
#: as many others set its threshold.
SAMPLE_ROWS = 1_500
#: They hold so many characters at most, which bounds the n-grams: a model has all of them.
#: A text that is longer than all may be is not learnt from.
SAMPLE_CHARS = 1 << 23
#: A text is rejected if its entropy is so many times as far above its language's mean as that
#: of the farthest held-back text, in deviations for its length.
SLACK = 2.0
#: From so many held-back texts a threshold is taken; a language with fewer uses that of all
#: languages, and one with none, or with too few in all, rejects nothing.
ENOUGH_HELD = 10
UNKNOWN = "und"
IDENTIFIED = ("guess", "confidence", "rejected", "entropies", "size")
#: Windows that a task remembers with their entropies.
MOST_KNOWN = 400_000
_MIX = np.uint64(0xD6E8FEB86659FD93)
_BLOCK = 1 << 18


def _folding() -> np.ndarray:
    """For every code point its lower case, or 32 if it is no letter."""
    fold = np.full(sys.maxunicode + 1, 32, np.uint32)
    for code in range(sys.maxunicode + 1):
        char = chr(code)
        if char.isalpha():
            low = char.lower()
            fold[code] = ord(low) if len(low) == 1 else code
    return fold


_FOLD: list[np.ndarray] = []


def letters(text: str) -> np.ndarray:
    """Code points in lower case, each run of other characters a single space, one at the
    end and none at the start; empty if there is no letter."""
    if not _FOLD:
        _FOLD.append(_folding())
    codes = _FOLD[0][np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    codes = np.append(codes, np.uint32(32)).astype(np.uint64)
    gap = codes == 32
    return codes[~gap | np.append(False, ~gap[:-1])]


def pieces(codes: np.ndarray, order: int) -> Iterator[np.ndarray]:
    """``codes`` in parts of bounded length, each behind the ``order`` - 1 places before it
    (spaces at the start)."""
    padded = np.concatenate((np.full(order - 1, 32, np.uint64), codes))
    for begin in range(0, len(codes), _BLOCK):
        yield padded[begin : begin + _BLOCK + order - 1]


class Windows:
    """All windows of ``order`` places over several pieces, none across two of them."""

    def __init__(self, parts: list[np.ndarray], order: int):
        whole = np.concatenate(parts)
        n = len(whole) - order + 1
        within = np.ones(n, bool)
        self.sizes = np.array([len(p) - order + 1 for p in parts])
        for k in range(1, order):
            within[np.cumsum([len(p) for p in parts[:-1]], dtype=np.int64) - k] = False
        at = np.flatnonzero(within)
        self.order, self.rows = order, [whole[k : k + n][at] for k in range(order)]

    def of(self, at: np.ndarray) -> Windows:
        """Some of the windows."""
        out = object.__new__(Windows)
        out.order, out.rows, out.sizes = self.order, [row[at] for row in self.rows], None
        return out

    def grams(self, n: int) -> np.ndarray:
        """Hashes of the last ``n`` places."""
        return _hashes(self.rows[self.order - n :])

    def contexts(self, n: int) -> np.ndarray:
        """Hashes of the places that go before the last one in the last ``n``."""
        return _hashes(self.rows[self.order - n : -1]) if n > 1 else np.zeros(len(self.rows[0]), np.uint64)


def _hashes(rows: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(rows[0]), np.uint64)
    for row in rows:
        out = (out ^ row) * _MIX
        out ^= out >> np.uint64(31)
    return out


@dataclass
class Level:
    """N-grams of one order: sorted hashes, and what each adds to the probability; sorted
    hashes of contexts, and the weight that each leaves to the order below."""

    grams: np.ndarray
    values: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Model:
    levels: list[Level]
    floor: float
    mean: float = float("inf")
    deviation: float = 0.0
    spread: float = 0.0
    farthest: float = float("inf")

    def rejects(self, entropy: float, size: int) -> bool:
        """Whether ``entropy`` over ``size`` places is out of line with held-back texts."""
        usual = max(self.deviation, self.spread / size**0.5)
        return entropy > self.mean + SLACK * self.farthest * usual


def lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def entropies(model: Model, windows: Windows) -> np.ndarray:
    """Minus the log probability (nats) of the last place of every window."""
    p = np.full(len(windows.rows[0]), model.floor)
    for n, level in enumerate(model.levels, 1):
        weight = lookup(level.contexts, level.weights, windows.contexts(n), 1.0)
        p = lookup(level.grams, level.values, windows.grams(n), 0.0) + weight * p
    return -np.log(p)


class Scorer:
    """Cross-entropies of texts under all models; windows seen before are remembered."""

    def __init__(self, models: dict[str, Model]):
        self.models = list(models.values())
        self.order = len(self.models[0].levels)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.values = np.zeros((0, len(self.models)))

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text and model the mean entropy per place; per text its places (0: no letter)."""
        sums, sizes = np.zeros((len(texts), len(self.models))), np.zeros(len(texts), np.int64)
        rows, parts, held = [], [], 0
        for k, text in enumerate(texts):
            codes = letters(text)
            sizes[k] = len(codes)
            for part in pieces(codes, self.order):
                rows.append(k)
                parts.append(part)
                held += len(part)
                if held >= _BLOCK:
                    np.add.at(sums, rows, self._sums(parts))
                    rows, parts, held = [], [], 0
        if parts:
            np.add.at(sums, rows, self._sums(parts))
        return sums / np.maximum(sizes, 1)[:, None], sizes

    def _sums(self, parts: list[np.ndarray]) -> np.ndarray:
        windows = Windows(parts, self.order)
        place, distinct = pd.factorize(windows.grams(self.order))
        first = np.zeros(len(distinct), np.int64)
        first[place[::-1]] = np.arange(len(place))[::-1]
        values = self._values(distinct, windows.of(first))
        starts = np.cumsum(windows.sizes) - windows.sizes
        return np.stack([np.add.reduceat(v[place], starts) for v in values.T], axis=1)

    def _values(self, hashes: np.ndarray, windows: Windows) -> np.ndarray:
        if len(self.known) > MOST_KNOWN:
            self._forget()
        at = np.searchsorted(self.known, hashes)
        seen = np.zeros(len(hashes), bool)
        inside = at < len(self.known)
        seen[inside] = self.known[at[inside]] == hashes[inside]
        out = np.empty((len(hashes), len(self.models)))
        out[seen] = self.values[at[seen]]
        if not seen.all():
            new = windows.of(np.flatnonzero(~seen))
            out[~seen] = np.stack([entropies(m, new) for m in self.models], axis=1)
            sort = np.argsort(hashes[~seen])
            into = at[~seen][sort]
            self.known = np.insert(self.known, into, hashes[~seen][sort])
            self.values = np.insert(self.values, into, out[~seen][sort], axis=0)
        return out


def gram_counts(texts: DataFrame, order: int = ORDER) -> DataFrame:
    """How often each n-gram occurs in ``texts`` (lang, text): lang, n (1 to ``order``),
    hashes of the ``gram``, of its ``context`` (without the last character) and of its
    ``suffix`` (without the first), ``count``."""

    def counted(lang: str, parts: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        windows = Windows(parts, order)
        for n in range(1, order + 1):
            found, first, counts = np.unique(windows.grams(n), return_index=True, return_counts=True)
            some = windows.of(first)
            suffix = some.grams(n - 1) if n > 1 else np.zeros(len(first), np.uint64)
            yield pd.DataFrame({
                "lang": lang, "n": n, "gram": found.view(np.int64),
                "context": some.contexts(n).view(np.int64), "suffix": suffix.view(np.int64),
                "count": counts,
            })

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for lang, of_lang in frame.groupby("lang"):
                parts, held = [], 0
                for text in of_lang["text"]:
                    for part in pieces(letters(text), order):
                        parts.append(part)
                        held += len(part)
                        if held > 8 * _BLOCK:
                            yield from counted(lang, parts)
                            parts, held = [], 0
                if parts:
                    yield from counted(lang, parts)

    schema = "lang string, n int, gram bigint, context bigint, suffix bigint, count bigint"
    rows = texts.select("lang", "text").mapInPandas(count, schema)
    return rows.groupBy("lang", "n", "gram", "context", "suffix").agg(F.sum("count").alias("count"))


def fit_models(texts: DataFrame, order: int = ORDER) -> dict[str, Model]:
    """A model for each ``lang`` of ``texts`` (lang, text), with all their n-grams. Counts and
    continuation counts are aggregated by Spark; models come to the driver, so the texts have
    to be a bounded sample."""
    counts = materialize(gram_counts(texts, order), "grams")
    wider = counts.where("n > 1").groupBy("lang", (F.col("n") - 1).alias("n"), F.col("suffix").alias("gram"))
    continued = wider.agg(F.count("*").alias("different"))
    joined = counts.drop("suffix").join(continued, ["lang", "n", "gram"], "left")
    c = F.when(F.col("n") == order, F.col("count")).otherwise(F.col("different"))
    used = joined.select("lang", "n", "gram", "context", c.alias("c")).where("c > 0")
    used = materialize(used, "kneser-ney")
    few = [F.sum((F.col("c") == k).cast("bigint")).alias(f"of_{k}") for k in (1, 2)]
    rare = {(r[0], r[1]): (r[2], r[3]) for r in used.groupBy("lang", "n").agg(*few).collect()}
    data = used.toPandas()
    return {
        lang: Model(*_levels(of_lang, [rare.get((lang, n), (0, 0)) for n in range(1, order + 1)]))
        for lang, of_lang in data.groupby("lang")
    }


def _levels(data: pd.DataFrame, rare: list[tuple[int, int]]) -> tuple[list[Level], float]:
    levels = []
    for n, (ones, twos) in enumerate(rare, 1):
        rows = data[data["n"] == n]
        discount = ones / (ones + 2 * twos) if ones and twos else 0.5
        c = rows["c"].to_numpy(float)
        contexts, at = np.unique(rows["context"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        total = np.bincount(at, c)
        hashes = rows["gram"].to_numpy(np.int64).view(np.uint64)
        sort = np.argsort(hashes)
        values = ((c - discount) / total[at])[sort]
        levels.append(Level(hashes[sort], values, contexts, discount * np.bincount(at) / total))
    return levels, 1.0 / (2 * max(len(levels[0].grams), 1))


def learn(
    documents: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
    rows: int = SAMPLE_ROWS, order: int = ORDER,
) -> dict[str, Model]:
    """Models with thresholds from the labelled ``documents``; rows without a language or
    a text are not used. No such row: no model. Of each language at most ``rows`` texts with
    SAMPLE_CHARS characters are counted, and as many set the threshold."""
    wanted = documents.select(
        F.col(f"`{lang}`").alias("lang"),
        F.col(f"`{text}`").alias("text"),
        shuffle_order("language", F.col(f"`{doc_id}`")).alias("_order"),
    ).where("lang is not null and text is not null").where(F.length("text") <= SAMPLE_CHARS)
    sample = sampled(wanted, "_order", 2 * rows, "lang")
    counted = (F.col("_place") % 2 == 1).alias("counted")
    so_far = Window.partitionBy("lang", F.col("_place") % 2).orderBy("_place")
    chars = F.sum(F.length("text").cast("bigint")).over(so_far)  # at most ``rows`` rows each
    sample = sample.withColumn("_chars", chars).where(F.col("_chars") <= SAMPLE_CHARS)
    sample = materialize(sample.select("lang", "text", counted), "language-sample")
    models = fit_models(sample.where("counted"), order)
    if not models:
        return models
    held = sample.where("not counted").drop("counted")
    names = list(models)
    scored = identify(held, models, "text").where("size > 0 and guess = lang")
    h = F.element_at("entropies", F.array_position(F.array(*map(F.lit, names)), F.col("lang")).cast("int"))
    scored = scored.select("lang", "size", h.alias("h"))
    held_back = {r[0]: r[1:] for r in scored.groupBy("lang").agg(F.count("*"), F.avg("h"), F.stddev_pop("h")).collect()}
    if not held_back:
        return models
    means = F.create_map(*(F.lit(x) for n, (_, mean, _) in held_back.items() for x in (n, mean)))
    apart = F.col("h") - means[F.col("lang")]
    spreads = dict(scored.groupBy("lang").agg(F.sqrt(F.avg(F.col("size") * apart * apart))).collect())
    free = sum(n - 1 for n, _, _ in held_back.values())
    for lang, (n, mean, deviation) in held_back.items():
        spread = spreads[lang]
        if n < ENOUGH_HELD:
            if free < ENOUGH_HELD:
                continue
            pooled = sum(n * d * d for n, _, d in held_back.values()) / free
            deviation = max(deviation, pooled**0.5)
            pooled = sum(n * spreads[k] ** 2 for k, (n, _, _) in held_back.items()) / free
            spread = max(spread, pooled**0.5)
        models[lang].mean, models[lang].deviation, models[lang].spread = mean, deviation, spread
    known = {n: m for n, m in models.items() if m.mean < float("inf")}
    if not known:
        return models
    facts = F.create_map(*(
        F.lit(x) for n, m in known.items() for x in (n, F.array(*map(F.lit, (m.mean, m.deviation, m.spread))))
    ))[F.col("lang")]
    usual = F.greatest(facts[1], facts[2] / F.sqrt("size"))
    above = scored.where(F.col("lang").isin(*known)).select("lang", F.try_divide(F.col("h") - facts[0], usual).alias("z"))
    farthest = dict(above.groupBy("lang").agg(F.max("z")).collect())
    for lang, model in known.items():
        own = farthest.get(lang) if held_back[lang][0] >= ENOUGH_HELD else None
        of = [z for z in ([own] if own is not None else farthest.values()) if z is not None]
        model.farthest = max(1.0, *of) if of else float("inf")
    return models


def identify(
    documents: DataFrame, models: dict[str, Model], text: str = "text", with_text: bool = False
) -> DataFrame:
    """``documents``, without ``text`` if not asked for, with ``guess`` (a language of ``models``, or UNKNOWN
    for a null text, one without letters, or no models), ``confidence`` (0 to 1),
    ``rejected``, ``entropies`` (per model, in order) and ``size``.

    UNKNOWN is always rejected. Rows that repeat get equal results; ties go to the first
    model. An empty table gives no rows; columns of these names are replaced. The models are bounded by their parameters, hence
    they may be broadcast.
    """
    columns = [F.col(f"`{c}`") for c in documents.columns if c not in (text, *IDENTIFIED)]
    rows = documents.select(*columns, F.col(f"`{text}`"))
    schema = StructType([*(rows if with_text else documents.select(*columns)).schema.fields])
    for name, kind in (("guess", "string"), ("confidence", "double"), ("rejected", "boolean"),
                       ("entropies", ArrayType(DoubleType())), ("size", "long")):
        schema = schema.add(name, kind)
    shared = documents.sparkSession.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, known = list(shared.value), list(shared.value.values())
        scorer = Scorer(shared.value) if known else None
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            h, sizes = scorer(texts) if scorer else (np.zeros((len(texts), 0)), np.zeros(len(texts), int))
            guess, sure, rejected = [], [], []
            for own, n in zip(h, sizes):
                if not n or scorer is None:
                    guess.append(UNKNOWN), sure.append(0.0), rejected.append(True)
                    continue
                best = int(own.argmin())
                guess.append(names[best])
                sure.append(float(1.0 / np.exp(-np.minimum((own - own[best]) * n, 700)).sum()))
                rejected.append(known[best].rejects(own[best], n))
            made = [pa.array(guess, pa.string()), pa.array(sure, pa.float64()), pa.array(rejected, pa.bool_()),
                    pa.array(list(h), pa.list_(pa.float64())), pa.array(sizes, pa.int64())]
            own_columns = batch.columns if with_text else batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*own_columns, *made], schema.names)

    return rows.mapInArrow(run, schema)
