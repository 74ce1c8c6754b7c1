"""Toxicity by fuzzy lexicon search in context.

A lexicon of words and word beginnings is learned from labelled texts.  A
Levenshtein automaton is intersected with the lexicon's trie and determinised
into one transition table, which runs over all words of a block of texts at
once.  An edit is a letter put in, left out or changed, or two neighbours swapped,
the first letter included; entries of four letters and more allow one edit, those
of eight and more two.  Words with digits or signs inside (``id1ot``, ``st*pid``)
run as one, those characters standing for any letter.

Misspellings are sought of entries that at least ``COMMON`` of the toxic texts hold:
those of a rarer term would be too rare to learn from, and chance terms, of which
a large sample has hundreds, are rare.  How far an entry's misspellings speak for
it is learned too: where the texts that
hold them are as often harmless, they weigh nothing; without any such text they
weigh a fixed share of the entry.  Hits are scored in their context: inside
quotation marks they count apart, and hits that crowd one window of words add up.
A small logistic model turns all hits, misspelled, quoted and crowded ones into a
score from 0 to 1.

Labels are learned from a bounded sample (``SAMPLE`` labelled rows, lowest id
hashes; rows that repeat an id bring no more than ``SAMPLE`` feature rows to the
driver).  Null and empty texts have no hits and get the model's base score;
without labels of both kinds every score is the share of toxic labels (0 if
there are none).
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from quarry.llm.runtime import prepare
from quarry.plans.materialize import materialize

SAMPLE = 12_000        # labelled rows for lexicon and weights
LEXICON = 300          # entries, the strongest
THRESHOLD = 0.3
MIN_LIFT = 2.0         # log of the document-frequency ratio
REST_LIFT = 1.3        # the same without what shorter-listed terms explain
EVIDENCE = 14.0        # log of the odds against a chance term (millions are tried)
WINDOW = 20            # words
QUOTE_REACH = 80       # characters
SOFT = 0.8             # weight of a misspelling whose entry is never misspelled in the sample
COMMON = 0.05          # share of the toxic texts that hold an entry whose misspellings are sought
_SIGNS = "*@$!#%&+"    # stand for letters where letters or digits are on both sides
_QUOTES = '"“”„«»'
_FEATURES = 6
_OTHER = 1             # class of letters that no entry has; 0: no letter


@dataclass
class ToxicityModel:
    """Transition table (states x classes), outputs by state and weights."""

    chars: dict[str, int]
    table: np.ndarray
    word_exact: np.ndarray
    word_fuzzy: np.ndarray
    stem_exact: np.ndarray
    stem_fuzzy: np.ndarray
    weights: np.ndarray
    entries: list[tuple[str, bool, float]]

    def classes(self) -> np.ndarray:
        out = np.array([_OTHER if chr(c).isalpha() else 0 for c in range(0x10000)], np.uint16)
        for ch, k in self.chars.items():
            if ord(ch) < 0x10000:
                out[ord(ch)] = k
        return out


def edits_of(length: int) -> int:
    """Edits that an entry of ``length`` letters allows."""
    return 0 if length < 4 else 1 if length < 8 else 2


def compile_automaton(entries: list[tuple[str, bool, float]], soft: list[float] | None = None):
    """Determinised intersection of the edit automaton with the trie of ``entries``
    (text, is a beginning, weight); ``soft`` are the weights of misspellings (0: only
    exact ones are sought).  State 0 is dead, 1 the start."""
    chars = {c: i + 2 for i, c in enumerate(sorted({c for t, _, _ in entries for c in t}))}
    soft = [w for _, _, w in entries] if soft is None else soft
    children: list[dict[int, int]] = [{}]
    ends: list[list[tuple[bool, float, float, int]]] = [[]]
    below = [0]                                  # most edits of any entry from here on
    for (text, stem, weight), weak in zip(entries, soft, strict=True):
        node, most = 0, edits_of(len(text)) if weak > 0 else 0
        below[0] = max(below[0], most)
        for c in text:
            k = chars[c]
            if k not in children[node]:
                children[node][k] = len(children)
                children.append({})
                ends.append([])
                below.append(0)
            node = children[node][k]
            below[node] = max(below[node], most)
        ends[node].append((stem, weight, weak, most))

    # a position is a node, the edits so far and, after the second of two swapped
    # letters, the first one that must follow
    def closure(positions: set[tuple[int, int, int]]) -> frozenset:
        out, todo = set(positions), list(positions)
        while todo:
            node, e, due = todo.pop()
            for kid in children[node].values() if not due else ():  # a letter left out
                to = (kid, e + 1, 0)
                if e < below[kid] and to not in out:
                    out.add(to)
                    todo.append(to)
        least: dict[int, int] = {}
        for node, e, due in out:
            if not due:
                least[node] = min(e, least.get(node, e))
        return frozenset(x for x in out if x[2] or x[1] == least[x[0]])

    def move(state: frozenset, k: int) -> frozenset:
        out = set()
        for node, e, due in state:
            if due:
                if k == due:
                    out.add((node, e, 0))
                continue
            if e < below[node]:
                out.add((node, e + 1, 0))
            for c, kid in children[node].items():
                if c == k:
                    out.add((kid, e, 0))
                elif e < below[kid]:
                    out.add((kid, e + 1, 0))
                    swapped = children[kid].get(k)
                    if swapped is not None and e < below[swapped]:
                        out.add((swapped, e + 1, c))
        return closure(out)

    start = closure({(0, 0, 0)})
    number = {frozenset(): 0, start: 1}
    todo, rows = [start], {0: [0] * (len(chars) + 2)}
    while todo:
        state = todo.pop()
        row = [0] * (len(chars) + 2)
        for k in range(1, len(chars) + 2):
            to = move(state, k)
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row[k] = number[to]
        rows[number[state]] = row
    table = np.array([rows[i] for i in range(len(number))], np.int32)
    outputs = np.zeros((4, len(number)), np.float32)  # word exact / fuzzy, stem exact / fuzzy
    for state, i in number.items():
        for node, e, due in state:
            for stem, weight, weak, most in ends[node] if not due else ():
                if e <= most:
                    at = 2 * stem + (e > 0)
                    outputs[at, i] = max(outputs[at, i], weak if e else weight)
    return chars, table, outputs


def _run(model: ToxicityModel, kind: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Exact and misspelled weight of each span."""
    exact, fuzzy = np.zeros(len(start), np.float32), np.zeros(len(start), np.float32)
    live, at = np.arange(len(start)), start.copy()
    state = np.ones(len(start), np.int32)
    while len(live):
        state = model.table[state, kind[at]]
        np.maximum.at(exact, live, model.stem_exact[state])
        np.maximum.at(fuzzy, live, model.stem_fuzzy[state])
        at = at + 1
        done = at >= end[live]
        over = live[done]
        exact[over] = np.maximum(exact[over], model.word_exact[state[done]])
        fuzzy[over] = np.maximum(fuzzy[over], model.word_fuzzy[state[done]])
        stay = ~done & (state > 0)
        live, at, state = live[stay], at[stay], state[stay]
    fuzzy[exact > 0] = 0
    return exact, fuzzy


def _spans(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    edge = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    return np.flatnonzero(edge > 0), np.flatnonzero(edge < 0)


def _hits(model: ToxicityModel, classes: np.ndarray, cps: np.ndarray):
    """Word starts and ends, and the exact and misspelled weight of each.  What a
    word with digits or signs inside gives falls to its first run of letters."""
    kind = classes[np.minimum(cps, 0xFFFF)]
    letter = kind > 0
    start, end = _spans(letter)
    exact, fuzzy = _run(model, kind, start, end)
    digit = (cps >= 48) & (cps <= 57)
    plain = letter | digit
    odd = digit.copy()
    for lo, hi in zip(*_spans(np.isin(cps, [ord(c) for c in _SIGNS])), strict=True):
        if lo > 0 and hi < len(cps) and plain[lo - 1] and plain[hi]:
            odd[lo:hi] = True
    if odd.any() and len(start):
        mixed, over = _spans(letter | odd)
        bad, letters = (np.concatenate(([0], np.cumsum(x))) for x in (odd, letter))
        some = (bad[over] > bad[mixed]) & (letters[over] > letters[mixed])
        mixed, over = mixed[some], over[some]
        any_letter = kind.copy()
        any_letter[odd] = _OTHER
        whole, near = _run(model, any_letter, mixed, over)
        first, last = np.searchsorted(start, mixed), np.searchsorted(start, over)
        known = np.concatenate(([0], np.cumsum(exact + fuzzy)))
        new = (near > 0) & (whole == 0) & (known[last] == known[first])
        fuzzy[first[new]] = near[new]
    return start, end, exact, fuzzy


def features(model: ToxicityModel, classes: np.ndarray, texts: list[str]) -> np.ndarray:
    """Feature rows: 1, all hits, misspelled, quoted, crowd, density."""
    lowered = [t.lower() for t in texts]
    joined = "\n".join(lowered) + "\n"
    cps = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in lowered])))
    start, end, exact, fuzzy = _hits(model, classes, cps)
    n = len(texts)
    out = np.zeros((n, _FEATURES))
    out[:, 0] = 1
    hit = np.flatnonzero((exact > 0) | (fuzzy > 0))
    if not len(hit):
        return out
    words = np.searchsorted(start, first)
    owner = np.searchsorted(first, start[hit], "right") - 1
    quote = np.zeros(len(cps) + 1, np.int64)
    np.cumsum(np.isin(cps, [ord(c) for c in _QUOTES]), out=quote[1:])
    left = np.maximum(start[hit] - QUOTE_REACH, first[owner])
    right = np.minimum(end[hit] + QUOTE_REACH, first[owner + 1])
    quoted = ((quote[start[hit]] - quote[left]) % 2 == 1) & (quote[right] > quote[end[hit]])
    weight = exact[hit] + fuzzy[hit]
    for column, rows, value in ((1, ~quoted, weight), (2, ~quoted & (fuzzy[hit] > 0), fuzzy[hit]), (3, quoted, weight)):
        np.add.at(out[:, column], owner[rows], value[rows])
    free, own = hit[~quoted], owner[~quoted]
    if len(free):  # hits within a window of words from each hit on
        reach = np.minimum(np.searchsorted(free, free + WINDOW), np.searchsorted(free, words[own + 1]))
        np.maximum.at(out[:, 4], own, (reach - np.arange(len(free))).astype(float))
        np.add.at(out[:, 5], own, 1.0)
        out[:, 5] /= np.maximum(np.diff(words), 1)
    out[:, 1:4] = np.log1p(out[:, 1:4])
    out[:, 4] = np.log1p(out[:, 4])
    out[:, 5] = np.sqrt(out[:, 5])
    return out


def score_of(model: ToxicityModel, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ model.weights, -30, 30)))


def _terms_fn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, toxic) to partial document counts of words and beginnings."""
    import regex

    letters = regex.compile(r"[^\W\d_]+")
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = {w for w in letters.findall((text or "").lower()) if 2 <= len(w) <= 40}
            terms = {w + "$" for w in words}
            terms.update(w[:k] for w in words for k in range(4, min(len(w), 9)))
            counts[toxic].update(terms)
        terms = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([counts[1][t] for t in terms], pa.int64()),
             pa.array([counts[0][t] for t in terms], pa.int64())], names=["term", "bad", "good"])


def _lift(bad: int, good: int, n_bad: int, n_good: int) -> float:
    return math.log((bad + 0.5) / (n_bad + 1)) - math.log((good + 0.5) / (n_good + 1))


def choose_entries(rows, n_bad: int, n_good: int) -> list[tuple[str, bool, float]]:
    """Greedy lexicon: the strongest term first.  A term that an accepted one
    covers is skipped, and a beginning must still stand without the documents
    of the accepted terms it would cover."""
    found = [(bad * _lift(bad, good, n_bad, n_good), len(term), term, bad, good) for term, bad, good in rows]
    entries: list[tuple[str, bool, float]] = []
    seen: dict[str, tuple[int, int]] = {}
    for _, _, term, bad, good in sorted(found, key=lambda r: (-r[0], -r[1], r[2])):
        stem, text = not term.endswith("$"), term.rstrip("$")
        if any(text == t or (s and text.startswith(t)) for t, s, _ in entries):
            continue
        below = [c for t, c in seen.items() if stem and t.startswith(text)]
        rest_bad, rest_good = bad - sum(c[0] for c in below), good - sum(c[1] for c in below)
        if rest_bad < 3 or _lift(rest_bad, max(rest_good, 0), n_bad, n_good) < REST_LIFT:
            continue
        entries.append((text, stem, _lift(bad, good, n_bad, n_good)))
        seen[text] = (bad, good)
        if len(entries) == LEXICON:  # hundreds of chance terms would only blur the weights
            break
    return entries


def _misspelled_fn(shared):
    """(text, toxic) to partial counts of texts by entry misspelled in them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.toxicity import _hits
        from quarry.llm.words import text_blocks

        model = shared.value
        classes = model.classes()
        for batch in batches:
            counts: Counter = Counter()
            toxic = batch.column(1).to_pylist()
            for at, block in text_blocks(batch.column(0)):
                lowered = [t.lower() for t in block.to_pylist()]
                cps = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
                start, _, _, fuzzy = _hits(model, classes, cps)
                hit = np.flatnonzero(fuzzy > 0)
                owner = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), start[hit], "right")
                for text, entry in np.unique(np.column_stack([owner, fuzzy[hit]]).astype(np.int64), axis=0).tolist():
                    counts[entry, toxic[at + text]] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in counts], pa.int32()), pa.array([t for _, t in counts], pa.int32()),
                 pa.array(list(counts.values()), pa.int64())], names=["entry", "toxic", "n"])
    return run


def misspelled_weights(rows: DataFrame, entries: list[tuple[str, bool, float]], sought: list[bool] | None = None,
                       rounds: int = 6) -> list[float]:
    """Weight of each entry's misspellings: 0 unless ``sought``, else its own, times
    SOFT, times what the texts that hold them say (with one text's worth of prior as
    its exact hits).

    A misspelling of several entries is the heaviest one's.  When that loses its
    weight, the next round counts it for the next one, until nothing changes;
    entries that still lose theirs after the last round get none.
    """
    weights = [w * SOFT if sought is None or sought[k] else 0.0 for k, (_, _, w) in enumerate(entries)]
    spark = rows.sparkSession
    for left in range(rounds, 0, -1):
        # misspellings tell the rank of their entry in place of a weight
        order = sorted((k for k, w in enumerate(weights) if w > 0), key=lambda k: (weights[k], k))
        if not order:
            break
        rank = {k: i + 1.0 for i, k in enumerate(order)}
        chars, table, out = compile_automaton(entries, [rank.get(k, 0.0) for k in range(len(entries))])
        shared = spark.sparkContext.broadcast(
            ToxicityModel(chars, table, out[0], out[1], out[2], out[3], np.zeros(_FEATURES), entries))
        counted = {(order[r.entry - 1], r.toxic): r.n for r in rows.mapInArrow(_misspelled_fn(shared), "entry int, toxic int, n long")
                   .groupBy("entry", "toxic").agg(F.sum("n").alias("n")).collect()}
        lost = False
        for k, (_, _, weight) in enumerate(entries):
            bad, good = counted.get((k, 1), 0), counted.get((k, 0), 0)
            if k in rank and bad + good:
                right = (bad + 1 / (1 + math.exp(-weight))) / (bad + good + 1)
                now = weight * SOFT * max(0.0, 2 * right - 1)
                lost = lost or now == 0
                weights[k] = 0.0 if left == 1 and now < weights[k] else min(now, weights[k])
        if not lost:
            break
    return weights


def fit(train: DataFrame, text_col: str = "text", label_col: str = "toxic") -> ToxicityModel:
    """Learn from a bounded table of labelled texts (label 0 or 1)."""
    spark = train.sparkSession
    prepare(spark)
    rows = train.select(F.col(text_col).alias("text"), F.col(label_col).cast("int").alias("toxic")).filter("toxic in (0, 1)")
    # copies are no independent evidence; the sample is read several times
    rows, _ = materialize(rows.dropDuplicates(), "labelled")
    kinds = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_bad, n_good = kinds.get(1, 0), kinds.get(0, 0)
    lift = F.log((F.col("bad") + 0.5) / (n_bad + 1)) - F.log((F.col("good") + 0.5) / (n_good + 1))
    share = n_bad / (n_bad + n_good) if n_bad and n_good else 0.5
    n, q = F.col("bad") + F.col("good"), F.col("bad") / (F.col("bad") + F.col("good"))
    # n times the divergence of the term's toxic share from the overall one
    evidence = n * (q * F.log(q / share) + F.when(q < 1, (1 - q) * F.log((1 - q) / (1 - share))).otherwise(0.0))
    terms = (rows.mapInArrow(_terms_fn, "term string, bad long, good long")
             .groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
             .filter((F.col("bad") >= 3) & (lift >= MIN_LIFT) & (evidence >= EVIDENCE))
             .orderBy(F.desc(F.col("bad") * lift), F.desc(F.length("term")), "term"))
    # few of a bounded sample's terms have the evidence
    found = [tuple(r) for r in terms.collect()]
    entries = choose_entries(found, n_bad, n_good) if n_bad and n_good else []
    held = {term: bad for term, bad, _ in found}
    sought = [held[text if stem else text + "$"] >= COMMON * n_bad for text, stem, _ in entries]
    chars, table, out = compile_automaton(entries, misspelled_weights(rows, entries, sought))
    model = ToxicityModel(chars, table, out[0], out[1], out[2], out[3], np.zeros(_FEATURES), entries)
    share = n_bad / (n_bad + n_good) if n_bad + n_good else 0.0
    if not entries:
        model.weights[0] = math.log(max(share, 1e-9) / max(1 - share, 1e-9)) if n_bad + n_good else -30.0
        return model
    # bounded in rows, however many share an id: the feature rows fit the driver.
    # Learned from hits as they are spelled; misspellings then count by their
    # entries' own weights
    spelled = replace(model, word_fuzzy=np.zeros_like(out[1]), stem_fuzzy=np.zeros_like(out[3]))
    seen = np.array([tuple(r.x) + (r.toxic,) for r in rows.mapInArrow(
        _features_fn(spark.sparkContext.broadcast(spelled)), "toxic int, x array<double>")
        .orderBy(F.xxhash64("toxic", "x")).limit(SAMPLE).collect()])
    model.weights = _logistic(seen[:, :-1], seen[:, -1])
    return model


def _features_fn(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.toxicity import features
        from quarry.llm.words import text_blocks

        model = shared.value
        classes = model.classes()
        for batch in batches:
            for at, texts in text_blocks(batch.column(0)):
                x = features(model, classes, texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(at, len(texts)), pa.array(list(x), pa.list_(pa.float64()))], names=["toxic", "x"])
    return run


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> np.ndarray:
    """Newton steps of a ridge-penalised logistic regression."""
    order = np.lexsort(np.column_stack([x, y]).T)  # row order must not matter
    x, y = x[order], y[order]
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _score_fn(shared, text_at: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from quarry.llm.toxicity import features, score_of
        from quarry.llm.words import text_blocks

        model = shared.value
        classes = model.classes()
        for batch in batches:
            for at, texts in text_blocks(batch.column(text_at)):
                x = features(model, classes, texts.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(texts)) for c in batch.columns),
                     pa.array(score_of(model, x)), pa.array(np.expm1(x[:, 3]))], names=names)
    return run


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score",
          quoted_col: str = "quoted_weight") -> DataFrame:
    """``docs`` with a score from 0 to 1 and the weight of quoted hits; columns
    of these names are replaced."""
    spark = docs.sparkSession
    prepare(spark)
    kept = [c for c in docs.columns if c not in (score_col, quoted_col)]
    plain = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(kept)])
    fields = [*plain.schema.fields, T.StructField("s", T.DoubleType()), T.StructField("q", T.DoubleType())]
    done = plain.mapInArrow(_score_fn(spark.sparkContext.broadcast(model), kept.index(text_col), [f.name for f in fields]),
                            T.StructType(fields))
    return done.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)],
                       F.col("s").alias(score_col), F.col("q").alias(quoted_col))


def labelled_sample(docs: DataFrame, labels: DataFrame, keep, label_col: str = "toxic",
                    id_col: str = "doc_id", rows: int = SAMPLE) -> DataFrame:
    """(text, label) of at most ``rows`` labelled documents for which ``keep``
    (a condition on the id) holds: those with the smallest id hashes."""
    picked = (labels.select(F.col(id_col).alias("__q_id"), F.col(label_col).alias("__q_label"))
              .filter("__q_id is not null and __q_label is not null").filter(keep("__q_id"))
              .dropDuplicates(["__q_id"]).orderBy(F.xxhash64("__q_id"), "__q_id").limit(rows))
    return (docs.select(F.col(id_col).alias("__q_id"), F.col("text"))
            .join(F.broadcast(picked), "__q_id").select("text", F.col("__q_label").alias(label_col)))
