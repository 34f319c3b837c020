"""Conversation repair: Wagner-Fischer alignment of turns to the grammar ``(s?(ua)+)?``.

A conversation's turns, in order, are aligned to every feasible length of the target
string (``uaua...``, behind one kept ``s`` or not). Long conversations are cut into
pieces that are aligned apart, for every state of the grammar before and after a piece;
what joins the pieces are 16 costs each, so that one conversation may hold any share of
the rows. An audit names the edits in order: D(elete), I(nsert), K(eep), R(erole).

Nulls: a null role or text counts as one space; null turns come first; rows whose
conv_id is null are one conversation. Rows of one turn are ordered by role and then by a
hash of role and text. Repeated rows are counted, not carried: all but the first are
deleted. Roles count by their first letter; an empty role fits nowhere. An empty table
gives no rows, and columns other than conv_id, turn, role and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .skew import hot_keys, salted_join
from .store import materialise

PIECE_ROWS = 64
PIECE_BYTES = 4 << 20
BLANKS = " \t\n\x0b\f\r"
DELETE, INSERT, RETITLE, BROKEN = 2, 5, 1, 5  # fixed values: cost of an edit, of a truncated turn that stays
FAR = 1 << 50
# letters of turns, and states of the grammar: what was written last
U, A, S, NONE = 0, 1, 2, 3
STAYS, CUT = 0, 8  # bits of a turn's code: 0-3 the letter, 4 must be deleted, 8 truncated
BATCH = 256


def damage(conversations: DataFrame) -> DataFrame:
    """Planted faults by crc32 of ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row,
    1 empties its text, 2 removes ``[.!?]``, 3 repeats it, 4 makes it a user's."""
    own = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(own) % 20).alias("h"))
    return rows.where("h <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("h") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("h") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def _identified(df: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and two 128-bit hashes: of the whole row (r), of all but the turn (d)."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    df = df.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    conv, turn = [F.col("conv_id").isNull(), F.col("conv_id")], [F.col("turn").isNull(), F.col("turn")]
    hashes = {}
    for name, of in (("d", [*conv, "role", "text"]), ("r", [*conv, *turn, "role", "text"])):
        hashes |= {f"{name}1": F.xxhash64(*of), f"{name}2": F.xxhash64(F.lit("again"), *of)}
    return df.select("*", *[v.alias(k) for k, v in hashes.items()])


def _facts(rows: DataFrame) -> DataFrame:
    """One row per distinct turn, without its text: code, copies n, bytes, fault."""
    bare = F.rtrim("text", F.lit(BLANKS))
    letter = F.substring("role", 1, 1)
    facts = rows.select(
        "conv_id", "turn", "role", "r1", "r2", "d1", "d2",
        F.when(letter == "u", U).when(letter == "a", A).when(letter == "s", S).otherwise(NONE).alias("letter"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut"),
        F.octet_length("text").alias("bytes"),
    )
    facts = materialise(facts.groupBy(*facts.columns).agg(F.count("*").alias("n")), "turns")
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    seen = facts.groupBy("d1", "d2").agg(F.min(at).alias("first"), F.count("*").alias("c")).where("c > 1")
    facts = salted_join(facts, seen, ["d1", "d2"], hot_keys(seen, ["d1", "d2"], "c"), "r1", "left")
    again = F.coalesce(F.col("first") < at, F.lit(False))
    fault = F.when(F.col("blank"), "blank").when(again, "duplicate").when(F.col("cut"), "truncated").otherwise("")
    facts = facts.withColumn("fault", fault)
    code = F.col("letter") + F.when(F.col("fault").isin("blank", "duplicate"), 4).when(F.col("fault") == "truncated", CUT).otherwise(0)
    return facts.withColumn("code", code.cast("int"))


def _counts(facts: DataFrame) -> DataFrame:
    """Gaps and faults per conversation. Copies of a turn are blank, or duplicates but for the first."""
    n = lambda name, else_: F.sum(F.when(F.col("fault") == name, F.col("n")).otherwise(else_))
    more = F.when(F.col("fault") == "blank", 0).otherwise(F.col("n") - 1)
    gaps = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    return facts.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"),
        n("blank", 0).alias("blank"),
        n("duplicate", more).alias("duplicate"),
        F.sum((F.col("fault") == "truncated").cast("long")).alias("truncated"),
    )


def _tables(codes: list[np.ndarray], reps: list[np.ndarray]):
    """Wagner-Fischer tables of pieces of one length n, from the last turn to the first.

    ``after[x][i][:, k]``: the least cost of turning the turns from i on into k letters of
    which the last is x (u or a), an insert being made before some turn of the piece.
    Ukkonen's bands keep to the k that a cost up to the incumbent's allows.
    Returns (after, delete, keep) with the costs of deleting and of keeping a turn.
    """
    code, rep = np.array(codes), np.array(reps)
    size, n = code.shape
    letter, must, cut = code & 3, code & 4 > 0, code & 8 > 0
    delete = DELETE * rep
    keep = np.where(must, FAR, DELETE * (rep - 1) + BROKEN * cut)
    wrong = [np.where(letter == x, 0, RETITLE) for x in (U, A)]
    # the incumbent keeps all that may stay, the roles alternate, one insert mends the parity
    fixed = np.where(must, delete, keep).sum(1)
    place = np.cumsum(~must, 1) & 1
    turned = [np.where(must, 0, np.where(place == p, wrong[U], wrong[A])).sum(1) for p in (0, 1)]
    best = fixed + np.maximum(turned[0], turned[1]) + 2 * INSERT
    # deletes of extra copies are in every script: only what lies above them lets the alignment drift
    slack = int((best - DELETE * (rep - 1).sum(1)).max())
    down, up = slack // DELETE, slack // INSERT
    width = n + up + 1
    after = {}
    steps = INSERT * np.arange(width)
    for x in (U, A):
        table = [np.full((size, width), FAR) for _ in range(n + 1)]
        table[n][:, 0] = 0
        # the letter that stands k places before the end
        odd = np.arange(width) % 2 == 1
        for i in range(n - 1, -1, -1):
            lo, hi = max(0, n - i - down), min(width, n - i + up + 1)
            below = table[i + 1]
            row = below[:, lo:hi] + delete[:, i, None]
            cost = np.where(odd[None, 1:hi], wrong[x][:, i, None], wrong[1 - x][:, i, None]) + keep[:, i, None]
            first = max(lo, 1)
            np.minimum(row[:, first - lo :], below[:, first - 1 : hi - 1] + cost[:, first - 1 : hi - 1], out=row[:, first - lo :])
            row = np.minimum.accumulate(row - steps[lo:hi], axis=1) + steps[lo:hi]
            table[i][:, lo:hi] = np.minimum(row, FAR)
        after[x] = table
    return after, delete, keep


def _expected(state: int) -> int:
    return A if state == U else U


def _ways(after, delete, keep, code, j: int, entry: int, leave: int) -> tuple[int, list[tuple[str, int, int]]]:
    """Least cost of piece j from state ``entry`` to ``leave``, and how the cheapest scripts begin: (audit so far, next turn, letters left)."""
    n = delete.shape[1]
    gone = np.append(0, np.cumsum(delete[j]))
    reps = delete[j] // DELETE
    if leave in (S, NONE):
        if entry == leave:
            return int(gone[n]), [("D" * int(reps.sum()), n, 0)]
        if (entry, leave) != (NONE, S):
            return FAR, []
    found: list[tuple[int, str, int, int]] = []
    if leave in (U, A):
        row = after[leave][0][j]
        ks = np.arange(len(row))
        fits = (ks % 2 == 1) == (_expected(entry) == leave)
        fits[0] = entry == leave
        cost = np.where(fits, row, FAR)
        low = int(cost.min())
        if low < FAR:
            found += [(low, "", 0, int(k)) for k in np.flatnonzero(cost == low)]
    if entry == NONE:
        # behind a kept s; the turns before it go
        for i in np.flatnonzero((code[j] & 3 == S) & (keep[j] < FAR)):
            head = int(gone[i] + keep[j, i])
            audit = "D" * int(reps[:i].sum()) + "K" + "D" * int(reps[i] - 1)
            if leave == S:
                found.append((head + int(gone[n] - gone[i + 1]), audit + "D" * int(reps[i + 1 :].sum()), n, 0))
                continue
            row = after[leave][i + 1][j]
            cost = np.where((np.arange(len(row)) % 2 == 1) == (leave == U), row, FAR)
            cost[0] = FAR
            low = int(cost.min())
            if low < FAR:
                found += [(head + low, audit, int(i) + 1, int(k)) for k in np.flatnonzero(cost == low)]
    low = min((f[0] for f in found), default=FAR)
    return low, [f[1:] for f in found if f[0] == low]


def _backtrace(after, delete, keep, code, j: int, leave: int, audit: str, i: int, k: int) -> str:
    """The ASCII-least script from turn i with k letters left."""
    out, n = [audit], delete.shape[1]
    while i < n:
        here, copies = after[leave][i][j, k], int(delete[j, i]) // DELETE
        want = leave if k % 2 == 1 else 1 - leave
        if after[leave][i + 1][j, k] + delete[j, i] == here:
            out.append("D" * copies)
            i += 1
        elif k and after[leave][i][j, k - 1] + INSERT == here:
            out.append("I")
            k -= 1
        else:
            out.append(("K" if code[j, i] & 3 == want else "R") + "D" * (copies - 1))
            i, k = i + 1, k - 1
    return "".join(out)


def _batches(codes: list[np.ndarray], reps: list[np.ndarray]) -> Iterator[list[int]]:
    """Pieces of one length, those of like numbers of faults together: their bands are alike."""
    order = sorted(range(len(codes)), key=lambda q: (len(codes[q]), int((codes[q] >= 4).sum())))
    start = 0
    for q in range(1, len(order) + 1):
        if q == len(order) or len(codes[order[q]]) != len(codes[order[start]]) or q - start == BATCH:
            yield order[start:q]
            start = q


def _pieces():
    """Sorted facts -> pieces: at most PIECE_ROWS turns of one conversation, about PIECE_BYTES of text."""

    def close(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        facts = pa.Table.from_batches(rows).combine_chunks()
        conv = facts["conv_id"].combine_chunks()
        code, rep = (facts[c].to_numpy() for c in ("code", "n"))
        volume = facts["bytes"].to_numpy()
        same = np.zeros(len(facts), bool)
        if len(facts) > 1:
            left, right = conv.slice(0, len(facts) - 1), conv.slice(1)
            same[1:] = pa.compute.fill_null(pa.compute.equal(left, right), False).to_numpy(zero_copy_only=False)
            same[1:] |= pa.compute.and_(left.is_null(), right.is_null()).to_numpy(zero_copy_only=False)
        cuts, size, held = [], 0, 0
        for i, (s, v) in enumerate(zip(same.tolist(), volume.tolist())):
            if not s or size == PIECE_ROWS or held + v > PIECE_BYTES:
                cuts.append(i)
                size = held = 0
            size, held = size + 1, held + v
        ends = [*cuts[1:], len(facts)]
        codes, reps = [code[a:b] for a, b in zip(cuts, ends)], [rep[a:b] for a, b in zip(cuts, ends)]
        costs = np.full((len(cuts), 16), FAR)
        for batch in _batches(codes, reps):
            after, delete, keep = _tables([codes[q] for q in batch], [reps[q] for q in batch])
            block = np.array([codes[q] for q in batch])
            for j, q in enumerate(batch):
                for entry in range(4):
                    for leave in range(4):
                        costs[q, 4 * entry + leave] = _ways(after, delete, keep, block, j, entry, leave)[0]
        pair = np.zeros(len(facts), np.int64)
        a, b = code[:-1] & 3, code[1:] & 3
        pair[1:] = ~(((a == S) & (b == U)) | ((a == U) & (b == A)) | ((a == A) & (b == U)))
        inside = [int(pair[x + 1 : y].sum() + (rep[x:y] - 1).sum()) for x, y in zip(cuts, ends)]
        offsets = pa.array([*cuts, len(facts)], pa.int32())
        flat = lambda c: pa.ListArray.from_arrays(offsets, facts[c].combine_chunks())
        heads = facts.take(pa.array(cuts))
        return pa.RecordBatch.from_arrays(
            [heads["conv_id"].combine_chunks(), heads["turn"].combine_chunks(), heads["role"].combine_chunks()]
            + [heads[c].combine_chunks() for c in ("r1", "r2")]
            + [flat("code"), flat("n"), flat("r1"), flat("r2")]
            + [pa.array(list(costs), pa.list_(pa.int64())), pa.array(inside, pa.int64())]
            + [pa.array([int(code[x] & 3) for x in cuts], pa.int32()), pa.array([int(code[y - 1] & 3) for y in ends], pa.int32())],
            ["conv_id", "turn", "role", "p1", "p2", "code", "n", "r1", "r2", "costs", "illegal", "first", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a batch's end may cut a piece short; costs join whatever the cut
        for batch in batches:
            if batch.num_rows:
                yield close([batch])

    return run


def _path():
    """Per conversation, over its pieces' costs: total, illegal pairs, and each piece's (entry, exit) states on cheapest paths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv in batch.to_pylist():
                pieces = conv["pieces"]
                ahead = [[0, FAR, FAR, FAR]]  # least cost up to each piece, by state; NONE is kept in front
                state = np.full(4, FAR)
                state[NONE] = 0
                fore, tables = [state], [np.array(p["costs"]).reshape(4, 4) for p in pieces]
                for t in tables:
                    state = np.minimum((state[:, None] + t).min(0), FAR)
                    fore.append(state)
                # at the end u lacks its a, and a lone s lacks both
                state = np.array([INSERT, 0, 2 * INSERT, 0])
                back = [state]
                for t in reversed(tables):
                    state = np.minimum((t + state[None, :]).min(1), FAR)
                    back.append(state)
                back.reverse()
                total = int(back[0][NONE])
                illegal = sum(p["illegal"] for p in pieces)
                for p, q in zip(pieces, pieces[1:]):
                    illegal += (p["last"], q["first"]) not in ((S, U), (U, A), (A, U))
                for no, (p, t) in enumerate(zip(pieces, tables)):
                    on = fore[no][:, None] + t + back[no + 1][None, :] == total
                    ways = [int(w) for w in np.flatnonzero(on.ravel())]
                    out.append((conv["conv_id"], p["p1"], p["p2"], no, len(pieces), total, illegal, ways))
            names = ["conv_id", "p1", "p2", "no", "of", "cost", "illegal", "ways"]
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * 2, *[pa.int32()] * 2, *[pa.int64()] * 2, pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    return run


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece's ASCII-least audit for every pair of states it needs."""
    for batch in batches:
        codes = [np.array(x) for x in batch["code"].to_pylist()]
        reps = [np.array(x) for x in batch["n"].to_pylist()]
        ways = batch["ways"].to_pylist()
        audits: list[list[str]] = [[] for _ in codes]
        for group in _batches(codes, reps):
            after, delete, keep = _tables([codes[q] for q in group], [reps[q] for q in group])
            block = np.array([codes[q] for q in group])
            for j, q in enumerate(group):
                for way in ways[q]:
                    entry, leave = divmod(way, 4)
                    starts = _ways(after, delete, keep, block, j, entry, leave)[1]
                    audits[q].append(min(_backtrace(after, delete, keep, block, j, leave, *s) for s in starts))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(audits, pa.list_(pa.string()))], [*batch.schema.names, "audits"])


def _choose():
    """Per conversation: its audit, and each piece's entry state and audit; pieces' audits are prefix-free, so the first difference decides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv in batch.to_pylist():
                state, pieces = NONE, conv["pieces"]
                for p in pieces:
                    audit, way = min((x, w) for x, w in zip(p["audits"], p["ways"]) if w // 4 == state)
                    end = {U: "I", S: "II"}.get(way % 4, "") if p["no"] == len(pieces) - 1 else ""
                    out.append((conv["conv_id"], p["p1"], p["p2"], p["no"], len(pieces), state, audit + end))
                    state = way % 4
            names = ["conv_id", "p1", "p2", "no", "of", "entry", "audit"]
            types = [batch.schema.field("conv_id").type, *[pa.int64()] * 2, *[pa.int32()] * 3, pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], names)

    return run


def _edits():
    """Pieces with their audits -> one row per turn of the result: seq, the source's hashes (null: inserted), its new role (null: kept)."""
    names = {U: "user", A: "assistant"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for p in batch.to_pylist():
                state, row, copy, seq = p["entry"], 0, 0, 0
                for letter in p["audit"]:
                    if letter == "I":
                        state = _expected(state)
                        out.append((p["conv_id"], p["no"], p["of"], seq, None, None, names[state], "I"))
                        seq += 1
                        continue
                    if letter in "KR":
                        state = p["code"][row] & 3 if letter == "K" else _expected(state)
                        out.append((p["conv_id"], p["no"], p["of"], seq, p["r1"][row], p["r2"][row], None if letter == "K" else names[state], letter))
                        seq += 1
                    copy += 1
                    if copy == p["n"][row]:
                        row, copy = row + 1, 0
            fields = ["conv_id", "no", "of", "seq", "r1", "r2", "new_role", "edit"]
            types = [batch.schema.field("conv_id").type, *[pa.int32()] * 3, *[pa.int64()] * 2, pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*out), types)] if out else [pa.array([], t) for t in types], fields)

    return run


def _hashes(kind: str):
    """sha256 over the pieces of conversations that several pieces hold, which come sorted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, digest, some, begun = None, hashlib.sha256(), False, False
        ids, out = [], []
        for batch in batches:
            for c, body in zip(batch["conv_id"].to_pylist(), batch["body"]):
                if begun and c != conv:
                    ids.append(conv)
                    out.append(digest.hexdigest())
                    digest, some = hashlib.sha256(), False
                conv, begun = c, True
                if some:
                    digest.update(b"\n")
                digest.update(body.as_buffer())
                some = True
        if begun:
            ids.append(conv)
            out.append(digest.hexdigest())
        schema = pa.schema([("conv_id", pa.int64() if kind == "bigint" else pa.string()), ("sha", pa.string())])
        yield pa.RecordBatch.from_arrays([pa.array(ids, schema.field(0).type), pa.array(out, pa.string())], schema=schema)

    return run


class Repair:
    """The repair of a table of conversations (conv_id, turn, role, text).

    ``conversations()``: a row per conversation with its counts, cost and audit.
    ``turns()``: the repaired conversations' turns. ``digests()``: their sha256.
    """

    def __init__(self, df: DataFrame):
        kind = df.schema["conv_id"].dataType.simpleString()
        self.kind = "bigint" if kind in ("bigint", "int", "smallint", "tinyint") else "string"
        df = df.withColumns({"conv_id": F.col("conv_id").cast(self.kind), "turn": F.col("turn").cast("bigint")})
        self.rows = _identified(df)
        facts = materialise(_facts(self.rows), "facts")
        self.counts = _counts(facts)
        order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("r1").asc()]
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        run = facts.select("conv_id", "turn", "role", "r1", "r2", "code", "n", "bytes")
        run = run.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        one = f"conv_id {self.kind}, "
        pieces = run.mapInArrow(
            _pieces(),
            one + "turn bigint, role string, p1 bigint, p2 bigint, code array<int>, n array<bigint>, r1 array<bigint>, r2 array<bigint>, "
            "costs array<bigint>, illegal bigint, first int, last int",
        )
        pieces = materialise(pieces, "pieces")
        at = F.struct(F.col("turn").isNotNull().alias("has"), "turn", "role", "p1", "p2", "costs", "illegal", "first", "last")
        whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(at)).alias("pieces"))
        path = whole.mapInArrow(
            _path(), one + "p1 bigint, p2 bigint, no int, of int, cost bigint, illegal bigint, ways array<int>"
        )
        path = materialise(path, "path")
        self.totals = path.where("no = 0").select("conv_id", "cost", "illegal")
        needed = pieces.select("p1", "p2", "code", "n", "r1", "r2").join(path.select("conv_id", "p1", "p2", "no", "ways"), ["p1", "p2"])
        audits = needed.mapInArrow(_audits, needed.schema.simpleString()[7:-1] + ",audits:array<string>")
        audits = materialise(audits, "audits")
        each = F.sort_array(F.collect_list(F.struct("no", "p1", "p2", "ways", "audits")))
        chosen = audits.groupBy("conv_id").agg(each.alias("pieces"))
        chosen = materialise(
            chosen.mapInArrow(_choose(), one + "p1 bigint, p2 bigint, no int, of int, entry int, audit string"), "chosen"
        )
        parts_of = F.sort_array(F.collect_list(F.struct("no", "audit")))
        self.audits = chosen.groupBy("conv_id").agg(F.array_join(F.transform(parts_of, lambda p: p["audit"]), "").alias("audit"))
        edits = audits.select("p1", "p2", "code", "n", "r1", "r2").join(chosen, ["p1", "p2"])
        self.edits = edits.mapInArrow(
            _edits(), one + "no int, of int, seq int, r1 bigint, r2 bigint, new_role string, edit string"
        )

    def conversations(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        out = self.counts
        for more in (self.totals, self.audits):
            other = more.withColumnRenamed("conv_id", "c")
            out = out.join(other, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
        return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    def turns(self) -> DataFrame:
        """conv_id, no, of (number of the piece, and how many there are), seq, role, text, edit."""
        texts = self.rows.groupBy("r1", "r2").agg(F.first("role").alias("role"), F.first("text").alias("text"))
        edits = self.edits.where("edit <> 'I'").join(texts, ["r1", "r2"])
        fields = ["conv_id", "no", "of", "seq"]
        kept = edits.select(*fields, F.coalesce("new_role", "role").alias("role"), "text", "edit")
        return kept.union(self.edits.where("edit = 'I'").select(*fields, "new_role", F.lit(""), "edit"))

    def digests(self) -> DataFrame:
        """conv_id, sha: of ``role:text`` of the repaired turns, joined by newlines.

        A conversation of one piece is hashed where the piece is put together. The pieces of a
        longer one pass in order through one task, as its hash has to be taken in order; the
        task holds a batch of pieces at a time.
        """
        line = F.concat("role", F.lit(":"), "text")
        bodies = self.turns().groupBy("conv_id", "no", "of").agg(F.sort_array(F.collect_list(F.struct("seq", line.alias("line")))).alias("lines"))
        body = F.array_join(F.transform("lines", lambda x: x["line"]), "\n")
        bodies = bodies.select("conv_id", "no", "of", body.cast("binary").alias("body"))
        bodies = materialise(bodies.withColumn("sha", F.when(F.col("of") == 1, F.sha2("body", 256))).withColumn("body", F.when(F.col("of") > 1, F.col("body"))), "bodies")
        short = bodies.where("of = 1").select("conv_id", "sha")
        long = bodies.where("of > 1").repartition("conv_id").sortWithinPartitions("conv_id", "no").select("conv_id", "body")
        return short.union(long.mapInArrow(_hashes(self.kind), f"conv_id {self.kind}, sha string"))


def audit(df: DataFrame, ids: DataFrame) -> DataFrame:
    """``Repair`` of ``df``, one row for every conv_id of ``ids``, with ``repaired_sha256``."""
    repair = Repair(df)
    out = ids.select(F.col("conv_id").cast(repair.kind).alias("conv_id")).distinct()
    for more in (repair.conversations(), repair.digests()):
        other = more.withColumnRenamed("conv_id", "c")
        out = out.join(other, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    nothing = hashlib.sha256(b"").hexdigest()
    return out.select(
        "conv_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(nothing)).alias("repaired_sha256"),
    )
