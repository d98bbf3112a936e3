"""Repair of conversation structure: the cheapest edits that give roles ``(s?(ua)+)?``, computed once for each prefix that conversations share.

Rows of a conversation are ordered by turn (nulls first), then role, then the hash of the text. A row's first fault counts: blank (nothing but ``[\\x20\\x09-\\x0D]``), duplicate (role and text
seen earlier in the conversation), truncated (its last other character is none of ``.!?``). Edits: K keeps a row for 0, R gives it the role user or assistant for 1, D deletes it for 2 (which blank and duplicate rows
must be), I inserts an empty turn of user or assistant for 5; a truncated row that is not deleted adds 5. Only the first letter of a role counts, so a role may be kept wherever its letter fits; an empty one fits nowhere.

1. Rows without their texts are sorted by range, so that one conversation may lie in many tasks, and stored with their position. The first position of each role and text tells duplicates.
2. A conversation is cut where its rows leave a block of ``PIECE`` positions. A piece's signature has a letter for each row: x (must go), s, u, a, o (any other role), upper case where truncated.
3. Distinct signatures, sorted by range, are inserted into a prefix trie, of which a task holds the branch it is on: each node has the layer of the dynamic program, the cheapest (cost, edits) from each of the four
   states of the role pattern to each other. A shared prefix keeps its layers; a signature's last node gives its answer. Two ways to a state of equal cost never have edits of which one begins the other (inserts cost, and what
   remains is a letter a row), so the least edits so far remain the least.
4. The answers of the pieces of a conversation are put together in order. What all four states agree on is set aside, so what is held is what they differ in.
5. Texts travel once, to be edited and hashed in order, row by row. The digest of a conversation is that of one sequence, so its rows pass through one task, one batch at a time.

Null roles and texts count as one space, so such texts are blank and such roles must be changed; null turns come first; null conv_ids are one conversation; rows that repeat are duplicates; conversations of any number of
rows and very long texts are read whole; conversations without rows have zeros, no edits and the hash of nothing; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import PART_ROWS, give_back, join_counted, stored

PIECE_BITS = 8
PIECE = 1 << PIECE_BITS
# What edits cost.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
# Fixed value: the role pattern as an automaton. 0 is the start, 1 comes after s, 2 after u, 3 after a; 0 and 3 accept.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ACCEPT = (0, 3)
_SPACE = " \t\n\x0b\x0c\r"

Way = tuple[int, str]
Layer = list[list[Way | None]]


# --- the dynamic program ---


def _better(ways: list[Way | None], state: int, way: Way) -> bool:
    if ways[state] is None or way < ways[state]:
        ways[state] = way
        return True
    return False


def with_inserts(ways: list[Way | None]) -> list[Way | None]:
    """The same ways, with turns inserted after them where that is cheapest."""
    todo = [s for s in range(4) if ways[s]]
    while todo:
        state = todo.pop()
        cost, edits = ways[state]
        todo += [nxt for role in "ua" if (nxt := NEXT[role].get(state)) is not None and _better(ways, nxt, (cost + INSERT, edits + "I"))]
    return ways


def first_layer() -> Layer:
    """From each state, nothing read yet."""
    return [with_inserts([(0, "") if s == start else None for s in range(4)]) for start in range(4)]


def next_layer(layer: Layer, sign: str) -> Layer:
    role, more = sign.lower(), TRUNCATED if sign.isupper() else 0
    out = []
    for ways in layer:
        new: list[Way | None] = [None] * 4
        for state, way in enumerate(ways):
            if way is None:
                continue
            cost, edits = way
            _better(new, state, (cost + DELETE, edits + "D"))
            if sign == "x":
                continue
            if (nxt := NEXT.get(role, {}).get(state)) is not None:
                _better(new, nxt, (cost + more, edits + "K"))
            for to in "ua":
                if (nxt := NEXT[to].get(state)) is not None:
                    _better(new, nxt, (cost + REROLE + more, edits + "R"))
        out.append(with_inserts(new))
    return out


def trie_answers(signatures: Iterator[str]) -> Iterator[tuple[str, Layer]]:
    """(signature, layer of its last node) for sorted signatures. Held is the branch to the last node; a signature goes back to where it leaves it."""
    branch, before = [first_layer()], ""
    for signature in signatures:
        del branch[len(commonprefix((before, signature))) + 1 :]
        for sign in signature[len(branch) - 1 :]:
            branch.append(next_layer(branch[-1], sign))
        before = signature
        yield signature, branch[-1]


def packed(layer: Layer) -> str:
    return ";".join("" if way is None else f"{way[0]}{way[1] and ' ' + way[1]}" for ways in layer for way in ways)


def unpacked(text: str) -> Layer:
    ways = [None if x == "" else (int(x.partition(" ")[0]), x.partition(" ")[2]) for x in text.split(";")]
    return [ways[i : i + 4] for i in range(0, 16, 4)]


class Joined:
    """Ways from the start through pieces taken in order."""

    def __init__(self) -> None:
        self.agreed: list[str] = []
        self.ways: list[Way | None] = first_layer()[0]

    def add(self, layer: Layer) -> None:
        new: list[Way | None] = [None] * 4
        for way, after in zip(self.ways, layer, strict=True):
            for state, more in enumerate(after if way else ()):
                if more:
                    _better(new, state, (way[0] + more[0], way[1] + more[1]))
        same = len(commonprefix([w[1] for w in new if w]))
        self.agreed.append(next(w[1] for w in new if w)[:same])
        self.ways = [w and (w[0], w[1][same:]) for w in new]

    def answer(self) -> Way:
        cost, edits = min(w for s in ACCEPT if (w := self.ways[s]))
        return cost, "".join(self.agreed) + edits


# --- rows ---


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of rows (nulls: one space) that a checksum of id and turn drops, empties, strips of stops, repeats or gives the role user, one case in twenty each."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    case = F.crc32(F.concat(say("conv_id"), F.lit(":"), say("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", say("role").alias("role"), say("text").alias("text"), case.alias("case")).where("case <> 0")
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    out = out.select("conv_id", "turn", F.when(F.col("case") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.when(F.col("case") == 3, 2).otherwise(1).alias("times"))
    return out.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def _plain(rows: DataFrame) -> DataFrame:
    say = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), say("role"), say("text"))


def _text_hash(text: str = "text") -> Column:
    return F.unhex(F.md5(F.col(text).cast("binary")))


ORDER = ("conv_id", "turn", "role", "t")  # ascending, nulls first


def positions(rows: DataFrame) -> DataFrame:
    """conv_id, turn, pos (rising in the order of a conversation's rows), initial, last (character that is no space; empty if blank), k (same for the same conversation, role and text). Stored."""
    last = F.right(F.rtrim("text", F.lit(_SPACE)), F.lit(1))
    facts = _plain(rows).select("conv_id", "turn", "role", _text_hash().alias("t"), last.alias("last"), F.monotonically_increasing_id().alias("row"))
    inner = F.unhex(F.md5(F.concat_ws("|", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")), F.length("role"), "role", F.hex("t")).cast("binary")))
    facts = facts.repartitionByRange(*ORDER, "row").sortWithinPartitions(*ORDER, "row")
    return stored(facts.select("conv_id", "turn", F.monotonically_increasing_id().alias("pos"), F.substring("role", 1, 1).alias("initial"), "last", inner.alias("k")), "conv-rows")


def pieces(rows: DataFrame) -> DataFrame:
    """conv_id, piece, signature, blank, duplicate, truncated, illegal (within it), first and final (initials). rows: of positions()."""
    seen = stored(rows.groupBy("k").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1"), "conv-seen")
    again = join_counted(rows.select("k", "pos"), seen, "k", "n").where("pos > first")
    piece = F.shiftright("pos", PIECE_BITS).alias("piece")
    again = again.groupBy(piece).agg(F.collect_list("pos").alias("again"))
    found = rows.groupBy("conv_id", piece).agg(F.array_sort(F.collect_list(F.struct("pos", "initial", "last"))).alias("rows")).join(again, "piece", "left")
    again = F.coalesce("again", F.array().cast("array<long>"))
    fault = lambda r: F.when(r["last"] == "", "blank").when(F.array_contains(again, r["pos"]), "duplicate").when(r["last"].isin(".", "!", "?"), "").otherwise("truncated")
    found = found.select("conv_id", "piece", F.transform("rows", fault).alias("faults"), F.col("rows.initial").alias("initials"))
    role = lambda i: F.when(i.isin("s", "u", "a"), i).otherwise("o")
    sign = lambda i, f: F.when(f.isin("blank", "duplicate"), "x").when(f == "truncated", F.upper(role(i))).otherwise(role(i))
    n = F.size("initials")
    pair = F.zip_with(F.slice("initials", F.lit(1), n - 1), F.slice("initials", F.lit(2), n - 1), lambda x, y: F.concat(x, y))
    count = lambda name: F.size(F.filter("faults", lambda f: f == name)).cast("long").alias(name)
    return found.select("conv_id", "piece", F.array_join(F.zip_with("initials", "faults", sign), "").alias("signature"), count("blank"), count("duplicate"), count("truncated"),
                        F.size(F.filter(pair, lambda p: ~p.isin("su", "ua", "au"))).cast("long").alias("illegal"), F.get("initials", F.lit(0)).alias("first"), F.get("initials", n - 1).alias("final"))


def solved(found: DataFrame) -> DataFrame:
    """(signature, n, layer) of the distinct signatures of pieces. Stored."""
    signatures = found.groupBy("signature").agg(F.count("*").alias("n")).repartitionByRange("signature").sortWithinPartitions("signature")

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, int]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)

        held: list[tuple[str, int, str]] = []
        counts: list[int] = []
        for signature, layer in trie_answers(counts.append(n) or s for s, n in rows()):
            held.append((signature, counts.pop(), packed(layer)))
            if len(held) == PART_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], ["signature", "n", "layer"])
                held.clear()
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*held, strict=True)], ["signature", "n", "layer"])

    return stored(signatures.mapInArrow(walk, "signature string, n long, layer string"), "conv-solved")


_FAULTS = ("blank", "duplicate", "truncated", "illegal")
_VERDICT = "conv_id long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def verdicts(found: DataFrame) -> DataFrame:
    """conv_id, blank, duplicate, truncated, illegal, cost, audit of conversations with rows. found: stored pieces."""
    # A layer has 16 ways of some 260 characters at most, so 10,000 of them are sent at most.
    rows = join_counted(found, solved(found), "signature", "n", most=10_000).select("conv_id", "piece", *_FAULTS, "first", "final", "layer")
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, done = None, []

        def end() -> None:
            if begun:
                done.append((begun["conv_id"], *(begun[c] for c in _FAULTS), *begun["ways"].answer()))

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in list(zip(*done, strict=True))[:6]] + [pa.array([r[6] for r in done], pa.string())], ["conv_id", *_FAULTS, "cost", "audit"])

        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                for row in batch.slice(at, PART_ROWS).to_pylist():
                    if begun is None or begun["conv_id"] != row["conv_id"]:
                        end()
                        begun = row | {"ways": Joined()}
                    else:
                        for c in _FAULTS:
                            begun[c] += row[c]
                        begun["illegal"] += begun["final"] + row["first"] not in ("su", "ua", "au")
                        begun["final"] = row["final"]
                    begun["ways"].add(unpacked(row["layer"]))
                if done:
                    yield out()
                    done.clear()
        end()
        if done:
            yield out()

    return rows.mapInArrow(fold, _VERDICT)


class Editor:
    """Applies edits to the rows of one conversation, as they come."""

    def __init__(self, edits: str) -> None:
        self.edits, self.at, self.state = edits, 0, 0

    def _put(self, role: str | None, text: bytes, initial: str) -> tuple[str | None, bytes]:
        if role is None:
            initial = "a" if self.state == 2 else "u"
            role = "assistant" if initial == "a" else "user"
        self.state = NEXT[initial][self.state]
        return role, text

    def inserted(self) -> Iterator[tuple[str, bytes]]:
        while self.at < len(self.edits) and self.edits[self.at] == "I":
            self.at += 1
            yield self._put(None, b"", "")

    def row(self, role: str, text: bytes) -> Iterator[tuple[str, bytes]]:
        yield from self.inserted()
        edit = self.edits[self.at]
        self.at += 1
        if edit != "D":
            yield self._put(role if edit == "K" else None, text, role[:1])


def _edited(rows: DataFrame, convs: DataFrame, as_rows: bool) -> DataFrame:
    """Either the repaired rows (conv_id, position, role, text) or one row a conversation with everything. convs: all conv_ids; rows: what there is of them."""
    plain = _plain(rows).withColumn("t", _text_hash())
    facts = positions(rows)
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).alias("gaps")
    found = stored(pieces(facts), "conv-pieces")
    heads = convs.select("conv_id").distinct().withColumn("part", F.lit(0)).unionByName(facts.groupBy("conv_id").agg(gaps).withColumn("part", F.lit(1)), True).unionByName(verdicts(found).withColumn("part", F.lit(2)), True)
    both = heads.unionByName(plain.withColumn("part", F.lit(3)), True).repartition("conv_id").sortWithinPartitions("conv_id", "part", "turn", "role", "t")
    numbers = ("gaps", *_FAULTS, "cost")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begun, done, text = None, [], []

        def put(turns: Iterator[tuple[str, bytes]]) -> None:
            for role, said in turns:
                if as_rows:
                    text.append((begun["conv_id"], begun["n"], role, said))
                else:
                    begun["sha"].update((b"\n" if begun["n"] else b"") + role.encode() + b":" + said)
                begun["n"] += 1

        def end() -> None:
            if begun:
                put(begun["editor"].inserted())
                done.append((begun["conv_id"], *(begun[c] for c in numbers), begun["audit"], begun["sha"].hexdigest()))

        def out() -> pa.RecordBatch | None:
            if as_rows:
                columns = list(zip(*text, strict=True)) or [()] * 4
                kinds, names = (pa.int64(), pa.int64(), pa.string(), pa.binary()), ["conv_id", "position", "role", "text"]
            else:
                columns = list(zip(*done, strict=True)) or [()] * 9
                kinds, names = (*[pa.int64()] * 7, pa.string(), pa.string()), ["conv_id", *numbers, "audit", "repaired_sha256"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            text.clear()
            done.clear()
            return pa.RecordBatch.from_arrays([a.cast(pa.string()) if n == "text" else a for a, n in zip(arrays, names, strict=True)], names)

        for batch in batches:
            for at in range(0, batch.num_rows, PART_ROWS):
                part = batch.slice(at, PART_ROWS)
                told = part.select(["conv_id", "part", "role", *numbers, "audit"]).to_pylist()
                for row, said in zip(told, part.column("text").cast(pa.binary()), strict=True):
                    if row["part"] == 0:
                        end()
                        begun = {"conv_id": row["conv_id"], "n": 0, "sha": hashlib.sha256(), "audit": "", "editor": Editor(""), **dict.fromkeys(numbers, 0)}
                    elif row["part"] == 1:
                        begun["gaps"] = row["gaps"]
                    elif row["part"] == 2:
                        begun |= {c: row[c] for c in (*_FAULTS, "cost", "audit")} | {"editor": Editor(row["audit"])}
                    else:
                        put(begun["editor"].row(row["role"], said.as_py()))
                if done or text:
                    yield out()
        end()
        if done or text:
            yield out()
        give_back()

    both = both.select("conv_id", "part", "role", "text", *numbers, "audit")
    return both.mapInArrow(apply, "conv_id long, position long, role string, text string" if as_rows else f"conv_id long, {', '.join(f'{c} long' for c in numbers)}, audit string, repaired_sha256 string")


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, position (from 0), role, text of the repaired conversations."""
    return _edited(rows, rows, True)


def audits(rows: DataFrame, convs: DataFrame | None = None) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. convs: all conv_ids, where rows may lack some."""
    return _edited(rows, rows if convs is None else convs, False)
