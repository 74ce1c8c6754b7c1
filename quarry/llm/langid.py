"""Language identification by interpolated Kneser-Ney character models.

One 4-letter model per language, counted over all training texts (lower case,
everything but letters is a space).  A model is sorted arrays of n-gram codes
with discounted probabilities and sorted arrays of context codes with
interpolation weights.  A text gets the language of the lowest cross-entropy
per letter; the share given to it among all languages (temperature fitted on all
training texts) is the score, and a text more than 0.25 above the cross-entropy that
99.5 % of all training texts of that language stay under is marked not accepted.

Codes hold 16 bits a character (higher planes are folded).  Every n-gram is
kept.  Models of up to ``MOST_GRAMS`` n-grams reach the texts in one broadcast;
larger ones stay tables (n-grams and contexts of every order, counted by
Spark).  Of these only the values of the most frequent n-grams are broadcast;
all other n-grams of the texts are joined to the tables.

Null texts and texts without letters are ``und`` with score 0.  Of languages with
equal cross-entropy the first in name is taken; repeated training rows count as
often as they stand; without training rows every text is ``und``; an empty table gives no
rows; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

ORDER = 4
MOST_GRAMS = 2_000_000  # of all languages in a broadcast; more are joined
MOST_VALUES = 4_000_000  # log probabilities worked out ahead
SAMPLE = 0             # not read any more (a test sets it): every training row counts
BINS = 1_000           # of cross-entropy a nat, to find the limits in
BLOCK = 2 << 20
UNKNOWN = "und"
_GAP = " " * (ORDER - 1)
_U16 = [np.uint64(16 * i) for i in range(ORDER)]


def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x10000)])


_LETTER = _letters()


def gram_codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """n-gram codes of the block (one for each letter and word end) and the
    offsets of the texts among them."""
    lowered = [t.lower() for t in texts]
    joined = _GAP + _GAP.join(lowered) + _GAP
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = cps > 0xFFFF
    letter = _LETTER[np.where(wide, 0, cps)]
    if wide.any():
        kinds, back = np.unique(cps[wide], return_inverse=True)
        letter[wide] = np.array([chr(c).isalpha() for c in kinds])[back]
    code = np.where(letter, cps & 0xFFFF, 0x20).astype(np.uint64)
    at = np.flatnonzero(letter | (np.concatenate(([False], letter[:-1]))))
    at = at[at >= ORDER - 1]
    grams = np.zeros(len(at), np.uint64)
    for back in range(ORDER):
        grams |= code[at - back] << _U16[back]
    first = len(_GAP) + np.concatenate(([0], np.cumsum([len(t) + len(_GAP) for t in lowered])))
    return grams, np.searchsorted(at, first)


def has_letter(codes: np.ndarray) -> np.ndarray:
    return (codes & np.uint64(0xFFFF)) != np.uint64(0x20)


@dataclass
class Level:
    """One order of one language."""

    grams: np.ndarray
    shares: np.ndarray      # discounted count / context total
    contexts: np.ndarray
    weights: np.ndarray     # mass left to the next shorter order


@dataclass
class LanguageModels:
    languages: list[str]
    levels: list[list[Level]]
    floor: list[float]
    table: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    values: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    temperature: float = 10.0
    limits: list[float] = field(default_factory=list)
    tables: list[tuple[DataFrame, DataFrame]] | None = None  # a large model: n-grams and contexts of each order
    discounts: list[list[float]] = field(default_factory=list)

    def __getstate__(self):  # tables stay with the driver
        return self.__dict__ | {"tables": None}

    def slow(self, grams: np.ndarray) -> np.ndarray:
        """Log probabilities (grams x languages)."""
        out = np.empty((len(grams), len(self.languages)))
        for i, levels in enumerate(self.levels):
            p = np.full(len(grams), self.floor[i])
            for m, level in enumerate(levels, 1):
                mask = np.uint64((1 << (16 * m)) - 1)
                g = grams & mask
                share = _look(level.grams, level.shares, g, 0.0)
                weight = _look(level.contexts, level.weights, g >> np.uint64(16), 1.0)
                p = share + weight * p
            out[:, i] = np.log(p)
        return out

    def log_probs(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities, and which n-grams have to be joined (value 0)."""
        at = np.minimum(np.searchsorted(self.table, grams), max(len(self.table) - 1, 0))
        known = self.table[at] == grams if len(self.table) else np.zeros(len(grams), bool)
        out = np.zeros((len(grams), len(self.languages)))
        out[known] = self.values[at[known]]
        if self.levels and not known.all():
            out[~known] = self.slow(grams[~known])
            known[:] = True
        return out, ~known

    def sums(self, texts: list[str]):
        """Summed log probabilities (texts x languages), n-gram and letter
        counts, and of the n-grams to be joined the code and the text."""
        grams, off = gram_codes(texts)
        back, kinds = pd.factorize(grams)
        logs, rest = self.log_probs(kinds)
        letters = np.concatenate(([0], np.cumsum(has_letter(grams))))
        out = np.zeros((len(texts), len(self.languages)))
        for i in range(len(self.languages)):
            sums = np.concatenate(([0.0], np.cumsum(logs[back, i])))
            out[:, i] = sums[off[1:]] - sums[off[:-1]]
        left = np.flatnonzero(rest[back]) if rest.any() else np.zeros(0, np.int64)
        return out, np.diff(off), letters[off[1:]] - letters[off[:-1]], grams[left], np.searchsorted(off, left, "right") - 1


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def kneser_ney(grams: np.ndarray, counts: np.ndarray) -> tuple[list[Level], float]:
    """Levels from the shortest order up, and the share of an unseen letter."""
    levels = []
    for m in range(ORDER, 0, -1):
        ones, twos = (counts == 1).sum(), (counts == 2).sum()
        discount = ones / (ones + 2 * twos) if ones else 0.5
        order = np.argsort(grams)
        grams, counts = grams[order], counts[order]
        contexts, where = np.unique(grams >> np.uint64(16), return_inverse=True)
        total = np.bincount(where, weights=counts)
        levels.append(Level(grams, np.maximum(counts - discount, 0) / total[where], contexts,
                            np.bincount(where, weights=np.minimum(counts, discount)) / total))
        if m > 1:  # how many letters each shorter n-gram follows
            grams, counts = np.unique(grams & np.uint64((1 << (16 * (m - 1))) - 1), return_counts=True)
        else:
            floor = 1.0 / (len(grams) + 1)
    return levels[::-1], floor


def _count_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from quarry.llm.langid import BLOCK, gram_codes
    from quarry.llm.words import text_blocks

    for batch in batches:
        languages = batch.column(1).dictionary_encode()
        for code, name in enumerate(languages.dictionary.to_pylist()):
            texts = batch.column(0).filter(pa.array(languages.indices.to_numpy() == code))
            for _, block in text_blocks(texts, BLOCK):
                back, kinds = pd.factorize(gram_codes(block.to_pylist())[0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(kinds), pa.string()), pa.array(kinds.view(np.int64)),
                     pa.array(np.bincount(back, minlength=len(kinds)))], names=["lang", "gram", "n"])


def _tables(counted: DataFrame, names: list[str]):
    """n-gram and context tables of every order from the shortest up, discounts
    and the shares of an unseen letter; one array entry a language."""
    tables, discounts = [], []
    kinds = range(len(names))
    grams = counted.groupBy(F.col("gram").alias("g")).agg(
        F.array(*[F.sum(F.when(F.col("lang") == name, F.col("n")).otherwise(0)) for name in names]).alias("n"))
    for m in range(ORDER, 0, -1):
        grams, _ = materialize(grams, "level")
        few = grams.agg(*[F.sum(F.expr(f"int(n[{i}] = {k})")) for i in kinds for k in (1, 2)]).first()
        discounts.append([ones / (ones + 2 * twos) if ones else 0.5 for ones, twos in zip(few[::2], few[1::2], strict=True)])
        contexts, _ = materialize(
            grams.groupBy(F.expr("shiftrightunsigned(g, 16)").alias("c"))
            .agg(F.array(*[F.sum(F.expr(f"n[{i}]")) for i in kinds]).alias("total"),
                 F.array(*[F.sum(F.expr(f"least(n[{i}], {d!r}D)")) for i, d in zip(kinds, discounts[-1], strict=True)]).alias("low")),
            "contexts")
        tables.append((grams, contexts))
        seen = [F.sum(F.expr(f"int(n[{i}] > 0)")) for i in kinds]
        if m > 1:  # how many letters each shorter n-gram follows
            grams = grams.groupBy(F.expr(f"g & {(1 << (16 * (m - 1))) - 1}L").alias("g")).agg(F.array(*seen).alias("n"))
        else:
            floor = [1.0 / (k + 1) for k in grams.agg(*seen).first()]
    return tables[::-1], discounts[::-1], floor


def _joined_logs(models: LanguageModels, wanted: DataFrame) -> DataFrame:
    """(gram, logs): the log probabilities of distinct n-grams, by the tables."""
    spark = wanted.sparkSession
    p = wanted.select(F.col("gram").cast("long").alias("g")).distinct()
    below = spark.createDataFrame([(models.floor,)], "p array<double>")
    for m, ((grams, contexts), discounts) in enumerate(zip(models.tables, models.discounts, strict=True), 1):
        d = F.array(*[F.lit(float(v)) for v in discounts])
        kinds = (p if m == ORDER else p.select(F.expr(f"g & {(1 << (16 * m)) - 1}L").alias("g")).distinct())
        kinds = kinds.withColumn("c", F.expr("shiftrightunsigned(g, 16)"))
        if m == 1:
            kinds = kinds.crossJoin(F.broadcast(below))
        else:
            kinds = kinds.join(below, F.expr(f"g & {(1 << (16 * (m - 1))) - 1}L") == F.col("s"))
        below = (kinds.join(grams, "g", "left").join(contexts, "c", "left").withColumn("d", d)
                 .select(F.col("g").alias("s"), F.expr("""
                     transform(p, (b, i) -> if(coalesce(total[i], 0) = 0, b,
                         (greatest(coalesce(n[i], 0) - d[i], 0D) + low[i] * b) / total[i]))""").alias("p")))
    return below.select(F.col("s").alias("gram"), F.expr("transform(p, x -> ln(x))").alias("logs"))


def _sums_fn(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.langid import BLOCK
        from quarry.llm.words import text_blocks

        models = shared.value
        for batch in batches:
            for at, texts in text_blocks(batch.column(1), BLOCK):
                sums, n, letters, rest, owner = models.sums(texts.to_pylist())
                edges = pa.array(np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(texts)), pa.array(list(sums), pa.list_(pa.float64())), pa.array(n),
                     pa.array(letters), pa.ListArray.from_arrays(edges, pa.array(rest.view(np.int64)))],
                    names=["key", "sums", "n", "letters", "rest"])
    return run


def entropies(rows: DataFrame, models: LanguageModels) -> DataFrame:
    """(key, text) to (key, h, letters): cross-entropy per letter in each
    language and letter counts."""
    kind = rows.schema["key"].dataType.simpleString()
    out = rows.select("key", "text").mapInArrow(
        _sums_fn(rows.sparkSession.sparkContext.broadcast(models)),
        f"key {kind}, sums array<double>, n long, letters long, rest array<long>")
    if models.tables is not None:
        out, _ = materialize(out.withColumn("row", F.monotonically_increasing_id()), "sums")
        rest = (out.select("row", F.explode("rest").alias("gram")).groupBy("row", "gram").agg(F.count(F.lit(1)).alias("times")))
        # each n-gram's values once, each text's n-grams summed
        more = (rest.join(_joined_logs(models, out.select(F.explode("rest").alias("gram"))), "gram").groupBy("row")
                .agg(F.array(*[F.sum(F.expr(f"times * logs[{i}]")) for i in range(len(models.languages))]).alias("more")))
        out = (out.drop("rest").join(more, "row", "left")
               .withColumn("sums", F.expr("if(more is null, sums, zip_with(sums, more, (a, b) -> a + b))")))
    return out.select("key", F.expr("transform(sums, s -> -s / greatest(n, 1))").alias("h"), "letters")


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> LanguageModels:
    """Models of all languages of ``train``; rows without text or language do
    not count (``key_col`` is not read any more)."""
    spark = train.sparkSession
    prepare(spark)
    rows = (train.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .filter("text is not null and lang is not null"))
    counted, _ = materialize(rows.select("text", "lang").mapInArrow(_count_fn, "lang string, gram long, n long")
                             .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    sizes = {r.lang: r["count"] for r in counted.groupBy("lang").count().collect()}
    names = sorted(sizes)
    if not names:
        return LanguageModels(names, [], [])
    most = MOST_VALUES // len(names)
    if sum(sizes.values()) <= MOST_GRAMS:
        got = counted.toPandas()
        levels, floors = [], []
        for name in names:
            own = got[got.lang == name]
            one, floor = kneser_ney(own.gram.to_numpy().view(np.uint64), own.n.to_numpy())
            levels.append(one)
            floors.append(floor)
        models = LanguageModels(names, levels, floors)
        top = got.groupby("gram").n.sum().sort_values(ascending=False, kind="stable").index[:most]
        models.table = np.sort(top.to_numpy().view(np.uint64))
        models.values = models.slow(models.table)
    else:
        tables, discounts, floors = _tables(counted, names)
        models = LanguageModels(names, [], floors, tables=tables, discounts=discounts)
        top = counted.groupBy("gram").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "gram").limit(most)
        # a bounded number of values ahead; all others are joined
        ahead = _joined_logs(models, top).toPandas()
        grams = ahead.gram.to_numpy().view(np.uint64)
        order = np.argsort(grams)
        models.table = grams[order]
        models.values = np.array(ahead.logs.tolist()).reshape(-1, len(names))[order]
    _calibrate(rows, models)
    return models


def _calibrate(rows: DataFrame, models: LanguageModels) -> None:
    """Temperature and limits from every training row.  The limit of a language
    is read from counts in bins of cross-entropy: the largest value in the bin in
    which the 99.5 % are reached.  A language has as many bins at most as its range of
    values has, however many rows there are."""
    names = models.languages
    place = F.expr("int(array_position(names, key))")
    heats = (1.0, 2.0, 5.0, 10.0, 20.0, 40.0)
    loss = [F.sum(F.expr(f"ln(aggregate(h, 0D, (a, x) -> a + exp(-{t!r}D * (x - low)))) + {t!r}D * (own - low)")) for t in heats]
    bins = (entropies(rows.select(F.col("lang").alias("key"), "text"), models).filter("letters > 0")
            .withColumn("names", F.array(*[F.lit(n) for n in names]))
            .withColumn("own", F.element_at("h", place)).withColumn("low", F.array_min("h"))
            .groupBy("key", F.floor(F.col("own") * BINS).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("top"), *[x.alias(f"l{i}") for i, x in enumerate(loss)]))
    of_language = Window.partitionBy("key")
    got = (bins.withColumn("upto", F.sum("n").over(of_language.orderBy("bin"))).withColumn("all", F.sum("n").over(of_language))
           .groupBy("key").agg(F.min(F.expr("if(1000 * upto >= 995 * all, top, null)")).alias("limit"),
                               *[F.sum(f"l{i}").alias(f"l{i}") for i in range(len(heats))]).collect())
    losses = [sum(r[f"l{i}"] for r in sorted(got, key=lambda r: r.key)) for i in range(len(heats))]
    models.temperature = heats[int(np.argmin(losses))] if got else 10.0
    limits = {r.key: r.limit + 0.25 for r in got}
    models.limits = [limits.get(name, float("inf")) for name in names]


def predict(docs: DataFrame, models: LanguageModels, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, lang_pred (``und`` without letters or models), score
    and accepted."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    if not models.languages:
        return rows.select(F.col("key").alias("doc_id"), F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(False).alias("accepted"))
    names, limits = F.array(*[F.lit(n) for n in models.languages]), F.array(*[F.lit(v) for v in models.limits])
    t = float(models.temperature)
    return (entropies(rows, models).withColumn("low", F.array_min("h"))
            .withColumn("best", F.expr("int(array_position(h, low)) - 1"))
            .withColumn("share", F.expr(f"1 / aggregate(h, 0D, (a, x) -> a + exp(-{t!r}D * (x - low)))"))
            .select(F.col("key").alias("doc_id"),
                    F.when(F.col("letters") > 0, names[F.col("best")]).otherwise(UNKNOWN).alias("lang_pred"),
                    F.when(F.col("letters") > 0, F.col("share")).otherwise(0.0).alias("score"),
                    ((F.col("letters") > 0) & (F.col("low") <= limits[F.col("best")])).alias("accepted")))
