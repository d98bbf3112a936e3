"""Exact n-gram Jaccard join: near-duplicate documents linked, and their components.

A document's set holds the 64-bit hashes of its distinct k-word shingles, kept as a sorted array. Two documents link when
``den * |A n B| >= num * |A u B|``. Pairs are found and judged in stages, each exact:

1. Documents with equal sets become one representative.
2. Prefix tokens: two sets that link share one of the first |A| - ceil(t|A|) + 1 hashes in a common order, so only those
   are posted, with a quarter more (see 4). A token held by one set says nothing and goes.
3. In each token's group every member meets two leaders. That is linear in the group, and joins groups of near copies
   into components without forming their pairs.
4. What is left are pairs of different components. Tokens of at most ``small`` sets form them directly. For a
   token above that, a set is "complete" if its posted prefix holds enough tokens that are not hot; two complete sets that link
   share one of these, so only pairs with an incomplete set remain. They meet in size-banded tiles of bounded rows: a tile
   compares hashed bitmaps, whose bit counts bound the overlap from above, and passes on pairs that can reach the threshold.
   A first round passes on only the likeliest pairs, which joins most sets that belong together; the second passes on all that are left.
5. Pairs go through the size band, the bitmaps' bound and then the intersection of both sorted arrays, which decides.

Components are found before and after 4. Nothing grows with the square of a group of near copies: of those, step 4 sees only sets
that no leader linked. Nothing is collected but counts. Cut lineages are written to the shared folder.

Words are as in ``common``, after A-Z go to lower case. Fewer words than k: the whole sequence is the one shingle; no words or null text:
the empty set, linked with nothing. Rows that repeat a doc_id and a set count once; the sets of a doc_id that repeats with other texts are one
document with the links of all of them, and give a row each. Null ids take no part in components and come back with a null one. Very long texts are sets like any other: only
their bitmaps are bounded. Of ties, documents equally like, all are linked. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest, xxh3_128_digest

from ledgerloom.llm.common import arrow_map, bounded_side, join_counted, stored, texts
from ledgerloom.llm.components import components

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


class Hashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 100_000:
            self.clear()
        found = self[word] = xxh3_64_intdigest(word)
        return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    return x ^ (x >> np.uint64(29))


def shingle_array(text: bytes, k: int, hashes: dict) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(k, len(w))
    n = len(w) - k + 1
    out = np.full(n, np.uint64(len(w) if len(words) < k else k), np.uint64)
    for i in range(k):
        out = _mix(out * _M1 + w[i : i + n])
    return np.unique(out)


def bits_of(n: int) -> int:
    """Bits of a set's bitmap, the same within a band of sizes: four to eight an element, 256 to 2^14 in all."""
    return 1 << min(14, max(8, int(n).bit_length() + 2))


def bitmap(a: np.ndarray) -> bytes:
    width = bits_of(len(a))
    flags = np.zeros(width, bool)
    flags[(a >> np.uint64(20)) & np.uint64(width - 1)] = True
    return np.packbits(flags, bitorder="little").tobytes()


def folded(b: bytes, size: int) -> np.ndarray:
    """A bitmap in as many bytes, halves laid over each other."""
    x = np.frombuffer(b, np.uint8)
    while len(x) > size:
        x = x[: len(x) // 2] | x[len(x) // 2 :]
    return x


def overlap_bound(na: np.ndarray, a: np.ndarray, nb: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Most that two sets can share: a bit that only one has is an element that only it has."""
    only_a = np.bitwise_count(a & ~b).sum(-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(-1, dtype=np.int64)
    return np.minimum(na - only_a, nb - only_b)


def links(na, nb, both, num: int, den: int):  # noqa: ANN001, ANN201
    return den * both >= num * (na + nb - both)


def _needed(n: int, num: int, den: int) -> int:
    """Elements that a set of n must share at least with any partner."""
    return -(-num * n // den)


def profile(docs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """doc_id, n, key (of the set), bits, prefix, need: hashes a prefix must hold to be sure of a shared one."""
    hashes = Hashes()

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        n, keys, bits, prefix, need = [], [], [], [], []
        for t in texts(batch.column(1)):
            a = shingle_array(t or b"", k, hashes)
            p = len(a) - _needed(len(a), num, den) + 1 if len(a) else 0
            n.append(len(a))
            need.append(p)
            keys.append(xxh3_128_digest(a.tobytes()) if len(a) else None)
            bits.append(bitmap(a) if len(a) else None)
            prefix.append(a[: p + p // 4 + 4 if p else 0].view(np.int64))
        sizes = np.cumsum([0, *map(len, prefix)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(sizes), pa.array(np.concatenate([*prefix, np.zeros(0, np.int64)])))
        return pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(bits, pa.binary()), lists, pa.array(need, pa.int32())], ["doc_id", "n", "key", "bits", "prefix", "need"])

    return arrow_map(docs.select("doc_id", "text"), f, "doc_id long, n long, key binary, bits binary, prefix array<long>, need int")


def in_band(a: Column, b: Column, num: int, den: int) -> Column:
    return F.least(a, b) * den >= F.greatest(a, b) * num


def bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose size band and bitmaps allow a link."""
    side = lambda x: sets.select(F.col("set").alias(x), F.col("n").alias(f"n{x}"), F.col("bits").alias(f"bits_{x}"))
    rows = pairs.join(side("a"), "a").join(side("b"), "b").where(in_band(F.col("na"), F.col("nb"), num, den))

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        na, nb = (batch.column(i).to_numpy() for i in (2, 3))
        keep = np.zeros(len(na), bool)
        ba, bb = batch.column(4).to_pylist(), batch.column(5).to_pylist()
        sizes = np.minimum([len(x) for x in ba], [len(x) for x in bb])
        for size in np.unique(sizes):
            at = np.flatnonzero(sizes == size)
            x, y = (np.array([folded(v[i], size) for i in at]) for v in (ba, bb))
            keep[at] = links(na[at], nb[at], overlap_bound(na[at], x, nb[at], y), num, den)
        out = batch.filter(pa.array(keep))
        return pa.RecordBatch.from_arrays(out.columns[:2], ["a", "b"])

    return arrow_map(rows.select("a", "b", "na", "nb", "bits_a", "bits_b"), f, "a long, b long")


def verified(pairs: DataFrame, source: DataFrame, names: DataFrame | None, k: int, num: int, den: int) -> DataFrame:
    """Pairs whose sorted arrays meet the threshold. Arrays are made again from source(doc_id, text) for the sets in question only. names: (key, doc_id, set) where ids repeat; else a set has the name of its document."""
    pairs = stored(pairs, "nj-pairs")
    hashes = Hashes()
    asked = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()

    def arrays(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingle_array(t or b"", k, hashes).tobytes() for t in texts(batch.column(1))]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxh3_128_digest(x) for x in found], pa.binary()), pa.array(found, pa.binary())], ["doc_id", "key", "array"])

    if names is None:
        texts_of = source.join(bounded_side(asked.withColumnRenamed("set", "doc_id")), "doc_id")
        whole = arrow_map(texts_of, arrays, "doc_id long, key binary, array binary").withColumnRenamed("doc_id", "set")
    else:
        asked = stored(names.join(bounded_side(asked), "set"), "nj-asked")
        texts_of = source.join(bounded_side(asked.select("doc_id").distinct()), "doc_id")
        whole = arrow_map(texts_of, arrays, "doc_id long, key binary, array binary").join(asked, ["doc_id", "key"]).dropDuplicates(["set"])
    whole = stored(whole.select("set", "array"), "nj-arrays")
    both = pairs.join(whole.select(F.col("set").alias("b"), F.col("array").alias("array_b")), "b").join(whole.select(F.col("set").alias("a"), F.col("array").alias("array_a")), "a")

    def f(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(v.as_py(), np.uint64) for v in (x, y))
            keep.append(bool(links(len(a), len(b), int(len(a) + len(b) - len(np.unique(np.concatenate([a, b])))), num, den)))
        out = batch.filter(pa.array(keep, pa.bool_()))
        return pa.RecordBatch.from_arrays(out.columns[:2], ["a", "b"])

    return stored(arrow_map(both.select("a", "b", "array_a", "array_b"), f, "a long, b long"), "nj-links")


def tiled_pairs(rows: DataFrame, sets: DataFrame, num: int, den: int, tile: int, most: int | None) -> DataFrame:
    """Pairs within groups, of an asking set and any other of another component, within the size band and the bitmaps' bound.

    rows: grp, set, n, component, asking. Sets are banded by size (partners are in the same band or the next) and bands cut
    into tiles of about ``tile`` rows, which blocks of as many asking sets of that band and its neighbours visit. most: so many pairs of each asking set in a tile, the likeliest first; None for all.
    """
    band = F.floor(F.log(F.col("n")) / F.lit(1.000001 * math.log(den / num))).cast("int")
    rows = stored(rows.withColumn("band", band), "nj-tiles")
    cuts = lambda c: F.ceil(F.col(c) / tile).cast("int")
    plan = rows.groupBy("grp", "band").agg(F.count("*").alias("m"), F.count_if("asking").alias("i")).select("grp", "band", cuts("m").alias("tiles"), cuts("i").alias("blocks"))
    near = plan.select("grp", F.col("band").alias("of"), "tiles", "blocks", F.explode(F.array(*(F.col("band") + d for d in (-1, 0, 1)))).alias("band"))
    at = lambda c, seed: F.pmod(F.xxhash64("set", F.lit(seed)), F.greatest(F.col(c), F.lit(1))).cast("int")
    # For each band, the bands nearby and their tiles and blocks, as one array: a row meets it in one join and is dealt out by it.
    around = near.groupBy("grp", "band").agg(F.collect_list(F.struct("of", "tiles", "blocks")).alias("around"))
    here = rows.join(plan.join(around, ["grp", "band"]), ["grp", "band"]).withColumns({"tile": at("tiles", 1), "block": at("blocks", 2)})
    each = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    place = lambda asks, tb, t, bb, b: F.struct(F.lit(asks).alias("asks"), tb.alias("tile_band"), t.alias("tile"), bb.alias("block_band"), b.alias("block"))
    answers = F.flatten(F.transform("around", lambda o: F.transform(each(o["blocks"]), lambda b: place(False, F.col("band"), F.col("tile"), o["of"], b))))
    asks = F.when(F.col("asking"), F.flatten(F.transform("around", lambda o: F.transform(each(o["tiles"]), lambda t: place(True, o["of"], t, F.col("band"), F.col("block")))))).otherwise(F.array().cast("array<struct<asks:boolean,tile_band:int,tile:int,block_band:int,block:int>>"))
    both = here.join(sets.select("set", "bits"), "set").select("grp", "set", "n", "component", "bits", F.inline(F.concat(answers, asks)))

    def f(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False)
        number = lambda c: group.column(c).to_numpy()
        maps, sets_, sizes, parts = group.column("bits").to_pylist(), number("set"), number("n"), number("component")
        there, out = np.flatnonzero(~asks), []
        if len(there) and len(there) < len(asks):
            width = min(map(len, maps))
            bits = np.array([folded(maps[i], width) for i in there])
            n, comp, ids = sizes[there], parts[there], sets_[there]
            for i in np.flatnonzero(asks):
                s, m = sets_[i], sizes[i]
                near = np.flatnonzero((comp != parts[i]) & (np.minimum(n, m) * den >= np.maximum(n, m) * num))
                if len(near):
                    bound = overlap_bound(m, folded(maps[i], width)[None, :], n[near], bits[near])
                    good = np.flatnonzero(links(m, n[near], bound, num, den))
                    if most is not None and len(good) > most:
                        good = good[np.argsort(-bound[good] / (m + n[near][good] - bound[good]), kind="stable")[:most]]
                    x = ids[near[good]]
                    out.append(np.array([np.minimum(s, x), np.maximum(s, x)]))
        pairs = np.concatenate([np.zeros((2, 0), np.int64), *out], axis=1)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return both.groupBy("grp", "tile_band", "tile", "block_band", "block").applyInArrow(f, "a long, b long")


def open_pairs(members: DataFrame, label: DataFrame, sets: DataFrame, num: int, den: int, small: int, tile: int, most: int | None) -> DataFrame:
    """Pairs of different components that share a posted token and are not yet excluded.

    Tokens of few sets form them by a join. In tokens of many, either the sets outside the token's main component ask, where these are fewer than
    the incomplete ones: they meet that component's sets and each other once for each main component, not for each token; or the incomplete ones ask
    all of the token.
    """
    placed = members.join(label.withColumnRenamed("node", "set"), "set", "left").withColumn("component", F.coalesce("component", "set"))
    parts = placed.groupBy("tok", "component").agg(F.count("*").alias("m"), F.count_if(~F.col("complete")).alias("i"))
    mixed = parts.groupBy("tok").agg(F.sum("m").alias("all_m"), F.sum("i").alias("incomplete"), F.max_by("component", F.struct("m", "component")).alias("main"), F.max("m").alias("main_m"), F.count("*").alias("parts")).where("parts > 1")
    rest = stored(join_counted(placed, stored(mixed, "nj-parts"), "tok", "all_m").select("tok", "held", "set", "n", "component", "complete", "main", "incomplete", (F.col("all_m") - F.col("main_m") < F.col("incomplete")).alias("by_main")), "nj-mixed")
    little = rest.where(F.col("held") <= small).select("tok", "set", "n", "component")
    other = little.select("tok", *(F.col(c).alias(f"{c}_b") for c in ("set", "n", "component")))
    direct = little.join(other, "tok").where((F.col("set") < F.col("set_b")) & (F.col("component") != F.col("component_b")) & in_band(F.col("n"), F.col("n_b"), num, den))
    hot = rest.where((F.col("held") > small) & (F.col("incomplete") > 0))
    by_main = hot.where("by_main").groupBy(F.concat(F.lit("c"), "main").alias("grp"), "set", "n", "component").agg(F.bool_or(F.col("component") != F.col("main")).alias("asking"))
    by_token = hot.where("not by_main").select(F.concat(F.lit("t"), "tok").alias("grp"), "set", "n", "component", (~F.col("complete")).alias("asking"))
    tiles = tiled_pairs(by_main.unionByName(by_token), sets, num, den, tile, most)
    # Pairs of the first join are few a token and formed once: the last round has them, whatever was linked before.
    return tiles if most is not None else tiles.unionByName(direct.select(F.col("set").alias("a"), F.col("set_b").alias("b")))


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, small: int = 48, tile: int = 2048) -> DataFrame:
    """doc_id, n_shingles, component_id: one row for each distinct id and set, and one for each row without an id."""
    rows = stored(profile(docs, k, num, den), "nj-profile")
    whole = rows.where("doc_id is not null")
    again = bool(whole.groupBy("doc_id").count().where("count > 1").limit(1).count())
    if again:  # ids that repeat, which the shuffle of all profiles is only spent on where there are any
        whole = stored(whole.dropDuplicates(["doc_id", "key"]), "nj-profile")
    # A set is named by the smallest id that has it; as that need not be one set's alone where ids repeat, there a hash of the set is its name.
    named = whole.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
    named = stored(named.withColumn("set", F.xxhash64("key") if again else F.col("doc_id")), "nj-named")
    # Read again where needed: the profile's rows of the ids that name a set.
    sets = whole.join(bounded_side(named), ["key", "doc_id"]).drop("doc_id")
    source = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    posted = sets.select("set", "n", F.explode("prefix").alias("tok"))
    one = F.struct("set", "n")
    leader = lambda seed, name: F.min_by(one, F.xxhash64("set", F.lit(seed))).alias(name)
    tokens = stored(posted.groupBy("tok").agg(F.count("*").alias("held"), F.min(one).alias("low"), F.max(one).alias("high"), leader(3, "l1"), leader(4, "l2")).where("held > 1"), "nj-tokens")
    many = tokens.where("held > 2").select("tok", "held", "l1", "l2")
    members = posted.join(bounded_side(many), "tok")
    hot_in = members.where(F.col("held") > small).groupBy("set").agg(F.count("*").alias("hot"))
    complete = sets.join(hot_in, "set").select("set", (F.size("prefix") - F.col("hot") >= F.col("need")).alias("complete"))
    members = stored(members.join(complete, "set", "left").withColumn("complete", F.coalesce("complete", F.lit(True))), "nj-members")
    near = lambda rows, x, y: rows.where(in_band(F.col(f"{x}.n"), F.col(f"{y}.n"), num, den)).select(F.least(f"{x}.set", f"{y}.set").alias("a"), F.greatest(f"{x}.set", f"{y}.set").alias("b"))
    led = near(members.select(F.struct("set", "n").alias("me"), F.explode(F.array("l1", "l2")).alias("l")).where("l.set <> me.set"), "me", "l")
    check = lambda pairs: verified(bounded(pairs.distinct(), sets, num, den), source, named if again else None, k, num, den)
    linked = check(near(tokens.where("held = 2"), "low", "high").unionByName(led))
    # The likeliest partners of sets outside their group's main component first, so that those who join it ask no more; then all.
    for most in (3, None):
        linked = linked.unionByName(check(open_pairs(members, components(linked), sets, num, den, small, tile, most)))

    if again:  # the sets of one id belong together
        of_id = whole.join(named.select("key", "set"), "key").groupBy("doc_id").agg(F.min("set").alias("a"), F.collect_set("set").alias("all")).where(F.size("all") > 1)
        linked = linked.unionByName(of_id.select("a", F.explode("all").alias("b")).where("a <> b"))
    label = components(linked).withColumnRenamed("node", "set")
    found = named.join(label, "set", "left").select("key", "doc_id", F.coalesce("component", "set").alias("component"))
    if again:
        least = found.groupBy("component").agg(F.min("doc_id").alias("least"))
        found = found.join(least, "component").select("key", F.col("least").alias("component"))
    of_all = whole.select("doc_id", "n", "key").unionByName(rows.where("doc_id is null").select("doc_id", "n", "key"))
    return of_all.join(found.select("key", "component"), "key", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
