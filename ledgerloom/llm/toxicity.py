"""Toxicity by a classifier chain.

Categories are predicted in a fixed order; each linear model sees hashed word and word-prefix features and the
probabilities of the categories before it. Those probabilities are out-of-fold when a model is trained, so that
it learns from the errors it will meet: features, kinds and links that made them never saw the document's fold. When documents are scored,
they come from models fitted on the whole sample.

Labels say toxic or not. The narrower categories are found in the data: features that mark toxic documents are grouped by the documents
they occur in, and a toxic document is of each kind whose features it holds most. The chain is kind_1, kind_2, ..., toxic.

Training uses a bounded sample of labelled documents (``max_positive``, ``max_negative``: those with the smallest hashes
of their id); scoring reads every document whole. Features are counted and chosen on the executors; the driver gets at most ``most`` of them for each set of folds
that a chain is trained on (eleven, for four folds and three categories) and the sample's rows of those.

Defined cases: null or empty text has no features and gets the probabilities of the bias; null ids are scored and
keep their null id; repeated labels of one id count once, as the highest; labels without a document and null labels are
ignored; repeated documents are each scored, and in training those of one id count once; with no labelled document
every probability is 0; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import arrow_map, drop, stored, texts
from ledgerloom.llm.linear import Rows, feature_hash, fit, sigmoid

BITS = 20
# Letters A-Z fall to lower case; ASCII that is neither letter nor digit separates words.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words_of(text: bytes) -> set[bytes]:
    return set(text.translate(_FOLD).split())


def features_of(word: bytes) -> tuple[int, ...]:
    """The word and its first three to seven characters."""
    out = [feature_hash(b"w" + word, BITS)]
    s = word.decode("utf-8", "replace")
    out += [feature_hash(b"p%d" % k + s[:k].encode(), BITS) for k in range(3, 8) if len(s) >= k]
    return tuple(out)


@dataclass
class Chain:
    categories: tuple[str, ...]
    place: dict[int, int]  # hashed feature -> column
    sparse: np.ndarray  # (categories, columns)
    dense: list[np.ndarray]  # of each category: weights of the earlier probabilities, then the bias

    def probabilities(self, columns: list[list[int]]) -> np.ndarray:
        return predict(Rows([np.array(c, np.int64) for c in columns], None, len(self.place)), list(zip(self.sparse, self.dense, strict=True)))


@dataclass
class Sample:
    """The training sample, by document id: its rows of features, the target and the fold of each, and for each set of folds the features (as columns) that the documents in it choose, with their scores."""

    features: np.ndarray
    rows: Rows
    target: np.ndarray
    fold: np.ndarray
    chosen: dict[frozenset[int], tuple[np.ndarray, np.ndarray]]


def subsets(folds: int, without: int) -> list[frozenset[int]]:
    """All sets of folds that lack up to ``without`` of them."""
    return [frozenset(range(folds)) - set(gone) for k in range(without + 1) for gone in itertools.combinations(range(folds), k)]


def fit_chain(sample: Sample, kinds: int) -> Chain:
    """What a link learns from, of a document in fold g, are the probabilities of a shorter chain that was trained without fold g: its features and kinds were chosen without it, and what its own links learned
    from was made in the same way one level down. With f folds and c categories that takes chains on all sets that lack up to c - 1 folds, each once.
    """
    categories = (*(f"kind_{k + 1}" for k in range(kinds)), "toxic")
    every = max(sample.chosen, key=len)
    columns = sample.chosen[every][0]
    if not len(sample.target):
        return Chain(categories, {}, np.zeros((kinds + 1, 0)), [np.append(np.zeros(k), -40.0) for k in range(kinds + 1)])
    whole = kinds_of(sample.rows, sample.target, *sample.chosen[every], kinds)

    @functools.cache
    def labels(inside: frozenset[int]) -> np.ndarray:
        """Kinds and target of all documents, of which only those inside count. Kinds found without some folds take the names of those found in all that they share most documents with."""
        if inside == every:
            return np.column_stack([whole, sample.target])
        there = np.isin(sample.fold, list(inside))
        found = kinds_of(sample.rows, sample.target * there, *sample.chosen[inside], kinds)
        return np.column_stack([named_alike(found, whole * there[:, None]), sample.target])

    @functools.cache
    def links(inside: frozenset[int], many: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Weights of the first links of a chain trained on the documents of these folds."""
        at = np.flatnonzero(np.isin(sample.fold, list(inside)))
        known = np.zeros(sample.rows.width, bool)
        known[sample.chosen[inside][0]] = True
        before = links(inside, many - 1) if many > 1 else []
        earlier = np.zeros((len(sample.target), many - 1))
        for g in inside if many > 1 else ():
            held = np.flatnonzero(sample.fold == g)
            earlier[held] = predict(sample.rows.take(held), links(inside - {g}, many - 1))
        if not len(at):
            return [*before, (np.zeros(sample.rows.width), np.append(np.zeros(many - 1), -40.0))]
        return [*before, fit(sample.rows.take(at).only(known), earlier[at], labels(inside)[at, many - 1].astype(float))]

    found = links(every, kinds + 1)
    place = {int(f): i for i, f in enumerate(sample.features[columns])}
    return Chain(categories, place, np.array([w[columns] for w, _ in found]), [v for _, v in found])


def predict(x: Rows, links: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """(rows, links): each link's probability, given those of the links before it."""
    out = np.zeros((x.n, len(links)))
    for k, (w, v) in enumerate(links):
        out[:, k] = sigmoid(x.dot(w) + out[:, :k] @ v[:-1] + v[-1])
    return out


def named_alike(found: np.ndarray, like: np.ndarray) -> np.ndarray:
    """Columns of found in the order of the columns of like that they share most rows with, the closest pair first."""
    shared, out = (found.T @ like).astype(float), np.zeros_like(found)
    for _ in range(found.shape[1]):
        a, b = np.unravel_index(int(np.argmax(shared)), shared.shape)
        out[:, b] = found[:, a]
        shared[a], shared[:, b] = -1, -1
    return out


def sample(docs: DataFrame, labels: DataFrame, target: str, max_positive: int, max_negative: int, most: int, folds: int, without: int, least_docs: int = 4, z: float = 3.5) -> Sample:
    """The bounded training sample with what each set of folds that lacks up to ``without`` of them chooses.

    Chosen are features in ``least_docs`` documents of the set or more whose rates differ between the classes by z standard errors, the strongest ``most`` of them. A document's fold depends on its id alone.
    """
    known = labels.where(F.col(target).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(target).alias("y"))
    order = F.xxhash64("doc_id", F.lit(17))
    picked = [known.where(F.col("y") == v).orderBy(order, "doc_id").limit(k) for v, k in ((1, max_positive), (0, max_negative))]
    ids = F.broadcast(picked[0].unionByName(picked[1]))  # at most max_positive + max_negative rows of two numbers
    rows = docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "text", F.col("y").cast("int").alias("y"))

    known_words: dict[bytes, tuple[int, ...]] = {}

    def of(word: bytes) -> tuple[int, ...]:
        if (got := known_words.get(word)) is None:
            if len(known_words) > 200_000:
                known_words.clear()
            got = known_words[word] = features_of(word)
        return got

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [sorted(set().union(*map(of, words_of(t or b"")))) for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "y", "ids"])

    one = arrow_map(rows, f, "doc_id long, y int, ids array<int>").groupBy("doc_id").agg(F.min(F.struct("y", "ids")).alias("x"))
    one = stored(one.select("doc_id", "x.*", F.pmod(F.xxhash64("doc_id", F.lit(23)), F.lit(folds)).cast("int").alias("fold")), "toxic-sample")
    sizes = {r["fold"]: (r["p"], r["n"]) for r in one.groupBy("fold").agg(F.sum("y").alias("p"), F.count("*").alias("n")).collect()}
    in_fold = [F.col("fold") == g for g in range(folds)]
    counts = one.select("y", "fold", F.explode("ids").alias("f")).groupBy("f").agg(
        *(F.coalesce(F.sum(F.when(is_in, F.col("y"))), F.lit(0)).alias(f"hit_{g}") for g, is_in in enumerate(in_fold)), *(F.count_if(is_in).alias(f"there_{g}") for g, is_in in enumerate(in_fold)))
    sets = subsets(folds, without)
    scores = []
    for inside in sets:
        p, n = (sum(sizes.get(g, (0, 0))[k] for g in inside) for k in (0, 1))
        hit, there = (functools.reduce(lambda a, b: a + b, (F.col(f"{name}_{g}") for g in sorted(inside))) for name in ("hit", "there"))
        rate = there / max(1, n)
        score = (hit / max(1, p) - (there - hit) / max(1, n - p)) / F.sqrt(F.greatest(rate * (1 - rate), F.lit(1e-12)) * (1 / max(1, p) + 1 / max(1, n - p)))
        scores.append(F.when(there >= least_docs, score))
    strong = counts.select("f", F.posexplode(F.array(*scores)).alias("s", "z")).where(F.abs("z") >= z)
    # A set has at most 2^BITS features here, and as many as are asked for leave each task.
    place = F.row_number().over(Window.partitionBy("s").orderBy(F.desc(F.abs("z")), "f"))
    best = sorted((r["f"], r["s"], r["z"]) for r in strong.withColumn("place", place).where(F.col("place") <= most).collect())
    features = np.array(sorted({b[0] for b in best}), np.int64)
    chosen = {}
    for i, inside in enumerate(sets):
        mine = [(b[0], b[2]) for b in best if b[1] == i]
        chosen[inside] = (np.searchsorted(features, np.array([x for x, _ in mine], np.int64)), np.array([s for _, s in mine]))

    def g(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [x[np.isin(x, features)] for x in (np.array(v, np.int64) for v in batch.column(2).to_pylist())]
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(found, pa.list_(pa.int32())), batch.column(3)], ["doc_id", "y", "ids", "fold"])

    got = sorted(tuple(r) for r in arrow_map(one, g, "doc_id long, y int, ids array<int>, fold int").collect())
    drop(one)
    rows_of = Rows([np.searchsorted(features, np.array(r[2], np.int64)) for r in got], None, len(features))
    return Sample(features, rows_of, np.array([r[1] for r in got], np.int64), np.array([r[3] for r in got], np.int64), chosen)


def kinds_of(rows: Rows, toxic: np.ndarray, chosen: np.ndarray, scores: np.ndarray, kinds: int, rounds: int = 20) -> np.ndarray:
    """(documents, kinds) of 0 and 1. Features that mark toxic documents are grouped by k-means on the documents that hold them, from centres far apart; no randomness."""
    marks, members = chosen[scores > 0], np.flatnonzero(toxic)
    out = np.zeros((rows.n, kinds), np.int64)
    if not len(marks) or not len(members) or not kinds:
        return out
    at = np.full(rows.width, -1)
    at[marks] = np.arange(len(marks))
    part = rows.take(members)
    held, there = np.zeros((len(marks), len(members))), at[part.ids] >= 0
    held[at[part.ids[there]], part.row[there]] = 1
    unit = held / np.maximum(np.sqrt(held.sum(1, keepdims=True)), 1e-9)
    centres = unit[[int(np.argmax(scores[scores > 0]))]]
    while len(centres) < kinds:
        centres = np.vstack([centres, unit[[int(np.argmin((unit @ centres.T).max(1)))]]])
    for _ in range(rounds):
        group = (unit @ centres.T).argmax(1)
        centres = np.array([unit[group == k].sum(0) if (group == k).any() else centres[k] for k in range(kinds)])
        centres /= np.maximum(np.sqrt((centres**2).sum(1, keepdims=True)), 1e-9)
    counts = np.array([held[group == k].sum(0) for k in range(kinds)])
    out[members] = ((counts == counts.max(0)) & (counts > 0)).T
    return out


def train(docs: DataFrame, labels: DataFrame, max_positive: int = 3000, max_negative: int = 6000, kinds: int = 2, most: int = 2048, folds: int = 4) -> Chain:
    """Chain kind_1 -> kind_2 -> ... -> toxic. There must be more folds than kinds, so that each link is trained on one fold at least."""
    if folds <= kinds:
        raise ValueError("more folds than kinds are needed")
    return fit_chain(sample(docs, labels, "toxic", max_positive, max_negative, most, folds, kinds), kinds)


def score(docs: DataFrame, chain: Chain, threshold: float = 0.5) -> DataFrame:
    """doc_id, p_<category> of each, and toxic: whether the last category reaches the threshold."""
    schema = "doc_id long, " + ", ".join(f"p_{c} double" for c in chain.categories) + ", toxic boolean"

    class Columns(dict):
        def __missing__(self, word: bytes) -> frozenset:
            if len(self) > 200_000:
                self.clear()
            found = self[word] = frozenset(chain.place[f] for f in features_of(word) if f in chain.place)
            return found

    state: list = []

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not state:
            state.append(Columns())
        of = state[0].__getitem__
        rows = [sorted(frozenset().union(*map(of, words_of(t)))) if t else [] for t in texts(batch.column(1))]
        p = chain.probabilities(rows)
        return pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), *(pa.array(p[:, k]) for k in range(p.shape[1])), pa.array(p[:, -1] >= threshold)],
            ["doc_id", *(f"p_{c}" for c in chain.categories), "toxic"])

    return arrow_map(docs.select("doc_id", "text"), f, schema)
