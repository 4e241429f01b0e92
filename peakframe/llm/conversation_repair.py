"""Conversation structure repair: the cheapest edits that give a conversation legal roles, by dynamic programming over a grammar.

A conversation is a string of symbols, one for each turn's role and fault. Re-Pair names the commonest pairs of symbols, over all conversations, again and again. A symbol has one min-plus matrix: from
the state before (nothing yet, or the last role) to the state behind, the least cost and the audit, the edits' initials, as a rope. A rule's matrix is the product of those of its two symbols, so that
what conversations share is evaluated once. No audit between two states is the beginning of another of the same turns (insertions stand before a turn's own edit), so the least audit of a product is a
product of least audits. A very long conversation is cut into fragments: their matrices give the cost to go behind each, that gives the way through each, and those the states between.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from peakframe.llm.common import cut, ship, slices

#: States: nothing kept yet, then the role of the last turn that stays.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Symbols: role initial s, u, a or other, twice, plus one if truncated; and what must go.
INITIALS, GONE = "sua", 8
#: Costs of the edits, and of a truncated turn that stays.
REROLE, DELETE, INSERT, STAYS = 1, 2, 5, 5
#: Turns of a fragment.
FRAGMENT = 65_536
#: Rules of a round and rounds of Re-Pair: beyond them strings stay longer, with the same results. A rule must save this share of all symbols of a round together with the others.
ROUND_RULES, ROUNDS, SAVES = 32, 24, 0.01
#: Strings whose edits a task remembers.
MEMO = 100_000

BLANKS = " \t\n\x0b\x0c\r"
PRIME, BASE = (1 << 61) - 1, 1_000_003


class Rope:
    """A text as the two parts it is made of, with a hash, so that equal stretches are passed over in comparisons."""

    __slots__ = ("hash", "left", "power", "right", "size", "text")

    def __init__(self, text: str | None, left: Rope | None = None, right: Rope | None = None):
        self.text, self.left, self.right = text, left, right
        if left is None:
            self.size, self.power, self.hash = len(text), pow(BASE, len(text), PRIME), 0
            for c in text:
                self.hash = (self.hash * BASE + ord(c)) % PRIME
        else:
            self.size, self.power = left.size + right.size, left.power * right.power % PRIME
            self.hash = (left.hash * right.power + right.hash) % PRIME

    def __str__(self) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if x.left is None:
                out.append(x.text)
            else:
                todo += [x.right, x.left]
        return "".join(out)


def before(x: Rope, y: Rope) -> bool:
    """Whether x sorts before y."""
    a, b = [x], [y]
    while a and b:
        p, q = a.pop(), b.pop()
        if p.size == q.size and p.hash == q.hash:
            continue
        if p.left is not None and (p.size >= q.size or q.left is None):
            a += [p.right, p.left]
            b.append(q)
        elif q.left is not None:
            b += [q.right, q.left]
            a.append(p)
        else:
            n = min(p.size, q.size)
            if p.text[:n] != q.text[:n]:
                return p.text < q.text
            a += [Rope(p.text[n:])] if p.size > n else []
            b += [Rope(q.text[n:])] if q.size > n else []
    return bool(b)


def inserts(i: int, j: int) -> int | None:
    """How many insertions lead from state i to j."""
    if i == j:
        return 0
    return {(START, USER): 1, (START, ASSISTANT): 2, (SYSTEM, USER): 1, (SYSTEM, ASSISTANT): 2, (USER, ASSISTANT): 1, (ASSISTANT, USER): 1}.get((i, j))


#: Insertions that end a conversation behind each state.
ENDING = [0, 2, 1, 0]


def kept_state(state: int, initial: int) -> int | None:
    """The state behind a turn of this role (0, 1, 2: s, u, a) that is kept."""
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == 1:
        return USER if state != USER else None
    return ASSISTANT if initial == 2 and state == USER else None


def next_role(state: int) -> int:
    """The state behind a turn that is inserted or gets a new role: the only one that is legal there."""
    return ASSISTANT if state == USER else USER


Entry = tuple[int, Rope]
Matrix = list[list[Entry | None]]


def turn_matrix(symbol: int) -> Matrix:
    """Insertions, then the edit of one turn."""
    best: list[list] = [[None] * 4 for _ in range(4)]
    for i in range(4):
        for j in range(4):
            if (n := inserts(i, j)) is None:
                continue
            edits = [("D", j, DELETE)]
            if symbol != GONE:
                stays = STAYS * (symbol % 2)
                edits.append(("R", next_role(j), REROLE + stays))
                if (k := kept_state(j, symbol // 2)) is not None:
                    edits.append(("K", k, stays))
            for name, k, cost in edits:
                found = (n * INSERT + cost, "I" * n + name)
                best[i][k] = min(best[i][k] or found, found)
    return [[(x[0], Rope(x[1])) if x else None for x in row] for row in best]


def lesser(x: Entry | None, y: Entry | None) -> Entry | None:
    if x is None or y is None:
        return x or y
    if x[0] != y[0]:
        return x if x[0] < y[0] else y
    return y if before(y[1], x[1]) else x


def product_row(row: list[Entry | None], b: Matrix) -> list[Entry | None]:
    out: list[Entry | None] = []
    for k in range(4):
        ways = [(x[0] + y[0], x[1], y[1]) for x, y in ((row[j], b[j][k]) for j in range(4)) if x and y]
        least = min((w[0] for w in ways), default=0)
        best = None
        for c, x, y in ways:
            if c == least:
                best = lesser(best, (c, Rope(None, x, y)))
        out.append(best)
    return out


class Grammar:
    """Rules of Re-Pair, in rounds; symbols are characters. Matrices are made when first asked for."""

    def __init__(self, rounds: list[list[str]]):
        self.rounds = rounds
        self.rules = {chr(0x100 + k): pair for k, pair in enumerate(p for r in rounds for p in r)}
        self.names = [(pair, name) for name, pair in self.rules.items()]
        self.matrices: dict[str, Matrix] = {chr(65 + k): turn_matrix(k) for k in range(9)}
        self.memo: dict[str, tuple] = {}

    def compressed(self, text: str) -> str:
        for pair, name in self.names:
            text = text.replace(pair, name)
        return text

    def matrix(self, symbol: str) -> Matrix:
        todo = [symbol]
        while todo:
            x = todo[-1]
            if x in self.matrices:
                todo.pop()
            elif missing := [y for y in self.rules[x] if y not in self.matrices]:
                todo += missing
            else:
                a, b = (self.matrices[y] for y in self.rules[x])
                self.matrices[x] = [product_row(row, b) for row in a]
        return self.matrices[symbol]

    def whole(self, text: str) -> Matrix:
        """The matrix of a string of turns."""
        out: Matrix = [[(0, Rope("")) if i == k else None for k in range(4)] for i in range(4)]
        for c in self.compressed(text):
            m = self.matrix(c)
            out = [product_row(row, m) for row in out]
        return out

    def edits(self, text: str) -> tuple[int, str]:
        """(cost, audit) of a conversation."""
        if (got := self.memo.get(text)) is None:
            row: list[Entry | None] = [(0, Rope("")), None, None, None]
            for c in self.compressed(text):
                row = product_row(row, self.matrix(c))
            got = ended(row, [INSERT * n for n in ENDING])
            got = self.memo[text] = (got[0], str(got[1]) + "I" * ENDING[got[2]])
            if len(self.memo) > MEMO:
                self.memo.clear()
        return got


def ended(row: list[Entry | None], togo: list[int]) -> tuple[int, Rope, int]:
    """(cost, audit, state behind) of the best way, if `togo` is what each state behind will cost."""
    ways = [(x[0] + togo[k], x[1], k) for k, x in enumerate(row) if x]
    best = ways[0]
    for way in ways[1:]:
        if way[0] < best[0] or way[0] == best[0] and before(way[1], best[1]):
            best = way
    return best


# --- from rows to strings ---------------------------------------------------------------------------------------------
ORDER = ["conv", "turn", "role", "h1", "h2"]


def turns(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """conv, turn, role, text with the digest that orders rows of a turn and role; null roles and texts are one space."""
    role_, text_ = F.coalesce(F.col(f"`{role}`"), F.lit(" ")), F.coalesce(F.col(f"`{text}`"), F.lit(" "))
    return rows.select(F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), role_.alias("role"), text_.alias("text")).withColumns({"h1": F.xxhash64("role", "text"), "h2": F.xxhash64("text", F.lit("second"), "role")})


def counted_turns(rows: DataFrame) -> DataFrame:
    """A row for each different turn of `turns`: n copies, `first` if its role and text stand nowhere before in the conversation; initial 0 to 3 and fault 0 to 2 (none, truncated, blank)."""
    trimmed = F.rtrim("text", F.lit(BLANKS))
    fault = F.when(trimmed == "", 2).when(F.right(trimmed, F.lit(1)).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = [*ORDER, "initial", "fault"]
    each = cut(rows.select(*ORDER, code.alias("initial"), fault.alias("fault")).groupBy(*narrow).agg(F.count("*").alias("n")))
    same = [c for c in narrow if c != "turn"]
    first = each.groupBy(*same).agg(F.min(F.struct(F.col("turn").isNotNull().alias("t"), "turn")).alias("m")).select(*same, F.col("m.turn").alias("turn"), F.lit(0).cast("long").alias("n"), F.lit(1).alias("first"))
    return each.withColumn("first", F.lit(0)).unionByName(first).groupBy(*narrow).agg(F.sum("n").alias("n"), F.max("first").alias("first"))


COUNTS = ["distinct", "blank", "duplicate", "truncated", "illegal"]
PIECE = T.StructType([T.StructField("piece", T.LongType()), T.StructField("whole", T.BooleanType()), T.StructField("symbols", T.StringType())] + [T.StructField(c, T.LongType()) for c in ("least", "most", "first_turn", "last_turn", "first_role", "last_role", *COUNTS)])


def legal(a: int, b: int) -> bool:
    return (a, b) in ((0, 1), (1, 2), (2, 1))


class Piece:
    """A fragment of a conversation that rows are put into in order."""

    def __init__(self):
        self.symbols, self.size = [], 0
        self.turns = [None] * 4  # least, greatest, first, last
        self.roles = [None, None]
        self.counts = dict.fromkeys(COUNTS, 0)

    def put(self, turn: int | None, initial: int, fault: int, fresh: int, again: int) -> None:
        """One turn that is new, if `fresh`, and `again` copies of what stood before."""
        c, n = self.counts, fresh + again
        if turn is not None:
            if self.turns[0] is None:
                self.turns = [turn, turn, turn, turn]
                c["distinct"] += 1
            else:
                c["distinct"] += turn != self.turns[3]
                self.turns[1] = self.turns[3] = turn
        c["illegal"] += n - 1 + (self.roles[1] is not None and not legal(self.roles[1], initial))
        self.roles = [initial if self.roles[0] is None else self.roles[0], initial]
        if fault == 2:
            c["blank"] += n
            fresh, again = 0, n
        else:
            c["duplicate"] += again
            c["truncated"] += fresh * fault
        self.symbols.append(chr(65 + 2 * initial + fault) * fresh + chr(65 + GONE) * again)
        self.size += n

    def row(self) -> list:
        return ["".join(self.symbols), *self.turns, *self.roles, *self.counts.values()]


def fragments(rows: DataFrame, most: int = FRAGMENT) -> DataFrame:
    """PIECE columns behind conv: the conversations of `counted_turns` as strings, those of more than `most` turns, or at the edges of a range, in pieces. Ranges cut long conversations, too."""
    schema = T.StructType([rows.schema["conv"], *PIECE.fields])
    kind = pa.from_numpy_dtype("int64")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, runs, at, piece, waiting = TaskContext.get().partitionId() << 40, 0, None, None, None
        out: list[list] = []

        def close(last: bool, end: bool) -> None:
            # whole if all of the conversation is in it: neither before nor behind it in the range may be more of it
            nonlocal number, piece
            if piece is not None and piece.size:
                out.append([at[0], number, last and piece.whole and runs > 1 and not end, *piece.row()])
                number += 1
            piece = Piece()
            piece.whole = last

        def flush():
            columns = list(zip(*out, strict=True))
            out.clear()
            arrays = [pa.array(columns[0], type=waiting), pa.array(columns[1], kind), pa.array(columns[2], pa.bool_()), pa.array(columns[3], pa.string()), *(pa.array(c, kind) for c in columns[4:])]
            return pa.RecordBatch.from_arrays(arrays, names=schema.names)

        for batch in batches:
            waiting = batch.schema.field(0).type
            for conv, turn, initial, fault, n, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at is None or at[0] != conv:
                    close(True, False)
                    at, runs = (conv,), runs + 1
                while n:
                    room = most - piece.size
                    if not room:
                        close(False, False)
                        room = most
                    k = min(n, room)
                    piece.put(turn, initial, fault, first, k - first)
                    n, first = n - k, 0
            if len(out) > 1000:
                yield flush()
        close(True, True)
        if out:
            yield flush()

    ordered = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    return ordered.select("conv", "turn", "initial", "fault", "n", "first").mapInArrow(run, schema)


# --- Re-Pair ----------------------------------------------------------------------------------------------------------
def re_pair(strings: DataFrame) -> Grammar:
    """The grammar of (symbols, n) strings: in each round the commonest pairs that cannot overlap each other get names. A round counts pairs in tasks; only the commonest come to the driver."""
    rounds: list[list[str]] = []
    sc = strings.sparkSession.sparkContext
    for _ in range(ROUNDS):
        sent = sc.broadcast(rounds)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            grammar, found, total = Grammar(sent.value), Counter(), 0
            for batch in batches:
                for text, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    text = grammar.compressed(text)
                    total += n * len(text)
                    for pair, k in Counter(map("".join, zip(text, text[1:], strict=False))).items():
                        found[pair] += n * (k if pair[0] != pair[1] else text.count(pair))
            yield pa.RecordBatch.from_arrays([pa.array(["", *found]), pa.array([total, *found.values()], pa.int64())], names=["pair", "n"])

        pairs = strings.mapInArrow(run, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n")).orderBy((F.col("pair") != "").cast("int"), F.desc("n"), "pair").limit(4 * ROUND_RULES + 1).collect()
        total, chosen, saved = pairs[0]["n"] if pairs else 0, [], 0
        for r in pairs[1:]:
            pair = r["pair"]
            if r["n"] >= 2 and len(chosen) < ROUND_RULES and not any(pair[1] == x[0] or pair[0] == x[1] for x in chosen):
                chosen.append(pair)
                saved += r["n"]
        if not chosen or saved < SAVES * total:
            break
        rounds.append(chosen)
    return Grammar(rounds)


# --- evaluation -------------------------------------------------------------------------------------------------------
RESULT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def totals(rows: list[dict]) -> list[int]:
    """gaps, blank, duplicate, truncated and illegal of a conversation's pieces in order."""
    counts = {c: sum(r[c] for r in rows) for c in COUNTS}
    turn = role = least = most = None
    for r in rows:
        if r["least"] is not None:
            counts["distinct"] -= turn == r["first_turn"]
            turn, most = r["last_turn"], r["most"]
            least = r["least"] if least is None else least
        counts["illegal"] += role is not None and not legal(role, r["first_role"])
        role = r["last_role"]
    gaps = 0 if least is None else most - least + 1 - counts["distinct"]
    return [gaps, *(counts[c] for c in COUNTS[1:])]


def evaluated(pieces: DataFrame, found, rounds: list, fields: list[T.StructField], keys: list[str]) -> DataFrame:
    """keys of the rows of pieces, and what found(grammar, row) gives for each."""
    sent = pieces.sparkSession.sparkContext.broadcast(rounds)
    schema = T.StructType([pieces.schema[k] for k in keys] + fields)
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(T.StructType(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(sent.value)
        for batch in batches:
            out = [found(grammar, r) for r in batch.to_pylist()]
            arrays = [batch.column(batch.schema.get_field_index(k)) for k in keys]
            yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, type=kinds.field(i).type) for i, c in enumerate(zip(*out, strict=True) if out else [[]] * len(fields))], names=schema.names)

    return pieces.mapInArrow(run, schema)


def by_conversation(pieces: DataFrame, found, rounds: list | None, fields: list[T.StructField]) -> DataFrame:
    """conv and the columns that found(grammar, rows) gives for the pieces of each conversation, in order."""
    sent = pieces.sparkSession.sparkContext.broadcast(rounds or [])
    schema = T.StructType([pieces.schema["conv"], *fields])
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, held = Grammar(sent.value), []

        def close() -> pa.RecordBatch:
            rows = [[held[0]["conv"], *x] for x in found(grammar, held)]
            return pa.RecordBatch.from_arrays([pa.array(c, type=kinds.field(i).type) for i, c in enumerate(zip(*rows, strict=True))], names=schema.names)

        for batch in batches:
            for r in batch.to_pylist():
                if held and held[0]["conv"] != r["conv"]:
                    yield close()
                    held = []
                held.append(r)
        if held:
            yield close()

    return pieces.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, schema)


LONGS, INTS = T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
RESULTS = [*[T.StructField(c, T.LongType()) for c in RESULT], T.StructField("audit", T.StringType())]
FAR = 1 << 60


def long_results(long: DataFrame, rounds: list) -> DataFrame:
    """conv, RESULTS and piece for each piece of conversations of many fragments; counts and cost stand in the first piece, each has its part of the audit. Passes of rows without strings link them."""
    stats = [c for c in long.columns if c not in ("symbols", "whole")]

    def costs(grammar: Grammar, r: dict):
        return [[x[0] if x else FAR for row in grammar.whole(r["symbols"]) for x in row]]

    def backward(_: Grammar, rows: list[dict]):
        togo, out = np.array([INSERT * n for n in ENDING]), []
        for r in reversed(rows):
            out.append([r["piece"], togo.tolist()])
            togo = np.minimum((np.array(r["costs"]).reshape(4, 4) + togo).min(axis=1), FAR)
        got = totals(rows)
        return [[*x, *(got if k == 0 else [None] * 5), int(togo[START]) if k == 0 else None] for k, x in enumerate(reversed(out))]

    def ways(grammar: Grammar, r: dict):
        return [[ended(row, r["togo"])[2] if any(row) else START for row in grammar.whole(r["symbols"])]]

    def forward(_: Grammar, rows: list[dict]):
        state, out = START, []
        for r in rows:
            out.append([r["piece"], state])
            state = r["behind"][state]
        return [[*x, ENDING[state] if k == len(rows) - 1 else 0] for k, x in enumerate(out)]

    def audit(grammar: Grammar, r: dict):
        return [str(ended(grammar.whole(r["symbols"])[r["state"]], r["togo"])[1]) + "I" * r["ending"]]

    priced = evaluated(long, costs, rounds, [T.StructField("costs", LONGS)], stats)
    piece = T.StructField("piece", T.LongType())
    togo = cut(by_conversation(priced, backward, None, [piece, T.StructField("togo", LONGS), *RESULTS[:-1]]))
    strings = long.select("conv", "piece", "symbols").join(togo.drop("conv"), "piece")
    behind = evaluated(strings, ways, rounds, [T.StructField("behind", INTS)], ["conv", "piece"])
    states = cut(by_conversation(behind, forward, None, [piece, T.StructField("state", T.IntegerType()), T.StructField("ending", T.IntegerType())]))
    return evaluated(strings.join(states.drop("conv"), "piece"), audit, rounds, RESULTS[-1:], ["conv", "piece", *RESULT])


def repaired(texts: DataFrame, audits: DataFrame, ids: DataFrame) -> DataFrame:
    """conv, RESULTS and repaired_sha256: the rows of each conversation in order, as its audit edits them, go through the digest one behind the other; only the audit of one conversation is held."""
    none = {"turn": "long", "role": "string", "h1": "long", "h2": "long", "text": "string"}
    void = lambda df: df.withColumns({c: F.lit(None).cast(t) for c, t in none.items() if c not in df.columns})
    columns = ["conv", "tag", *none, "piece", *RESULT, "audit"]
    empty = {"piece": F.lit(0).cast("long"), **{c: F.lit(None).cast("long") for c in RESULT}, "audit": F.lit(None).cast("string")}
    both = void(audits.withColumn("tag", F.lit(1))).select(columns).unionAll(void(ids.withColumn("tag", F.lit(0)).withColumns(empty)).select(columns)).unionAll(texts.withColumn("tag", F.lit(2)).withColumns(empty).select(columns))
    schema = T.StructType([texts.schema["conv"], *RESULTS, T.StructField("repaired_sha256", T.StringType())])
    roles = {USER: b"user", ASSISTANT: b"assistant"}

    class Open:
        def __init__(self, conv):
            self.conv, self.counts, self.audit, self.at, self.state, self.digest, self.lines = conv, [0] * len(RESULT), "", 0, START, hashlib.sha256(), 0

        def line(self, role: bytes, text: bytes) -> None:
            self.digest.update(b"\n" * (self.lines > 0) + role + b":")
            self.digest.update(text)
            self.lines += 1

        def insert(self) -> None:
            while self.at < len(self.audit) and self.audit[self.at] == "I":
                self.state, self.at = next_role(self.state), self.at + 1
                self.line(roles[self.state], b"")

        def turn(self, role: str, text: str) -> None:
            self.insert()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit == "D":
                return
            self.state = next_role(self.state) if edit == "R" else kept_state(self.state, INITIALS.index(role[0]))
            self.line(roles[self.state] if edit == "R" else role.encode("utf-8", "surrogatepass"), text.encode("utf-8", "surrogatepass"))

        def row(self) -> list:
            self.insert()
            return [self.conv, *self.counts, self.audit, self.digest.hexdigest()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, done, kind = None, [], None

        def flush() -> pa.RecordBatch:
            c = list(zip(*done, strict=True))
            done.clear()
            return pa.RecordBatch.from_arrays([pa.array(c[0], type=kind), *(pa.array(x, pa.int64()) for x in c[1:7]), pa.array(c[7], pa.string()), pa.array(c[8], pa.string())], names=schema.names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for part in slices(batch, 3):
                for conv, tag, role, text, audit, *counts in zip(*(x.to_pylist() for x in part.columns), strict=True):
                    if open_ is None or open_.conv != conv:
                        if open_ is not None:
                            done.append(open_.row())
                        open_ = Open(conv)
                    if tag == 2:
                        open_.turn(role, text)
                    elif tag == 1:
                        open_.audit += audit
                        open_.counts = open_.counts if counts[-1] is None else counts
                if len(done) > 1000:
                    yield flush()
        if open_ is not None:
            done.append(open_.row())
            yield flush()

    return both.repartition("conv").sortWithinPartitions("conv", "tag", "piece", *ORDER[1:]).select("conv", "tag", "role", "text", "audit", *RESULT).mapInArrow(run, schema)


def repair_conversations(rows: DataFrame, ids: DataFrame | None = None, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", fragment: int = FRAGMENT) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for each conversation of rows, and for each of `ids` that has no rows (zeros, the digest of nothing).

    Turns go by number, nulls first; those of one number by role, then by a digest of role and text, so that repeated rows are neighbours. Null roles and texts are one space; a null conversation is one.
    Roles count by their first letter. Texts count whole; empty tables give no rows; other columns are left aside. The digest of a conversation's text is one chain, so its rows pass one task, one by one.
    """
    ship(rows.sparkSession)
    texts = turns(rows, conv, turn, role, text)
    pieces = cut(fragments(counted_turns(texts), fragment))
    grammar = re_pair(cut(pieces.groupBy("symbols").agg(F.count("*").alias("n"))))
    rounds = grammar.rounds
    whole = evaluated(pieces.filter("whole"), lambda g, r: [*totals([r]), *g.edits(r["symbols"])], rounds, RESULTS, ["conv", "piece"])
    cut_ones = pieces.filter("NOT whole")
    size = cut(cut_ones.groupBy("conv").agg(F.sum(F.char_length("symbols")).alias("size")).filter(F.col("size") > fragment).select("conv"))
    audits = whole
    if not cut_ones.isEmpty():
        long_one = cut_ones["conv"].eqNullSafe(size["conv"])
        short = cut_ones.join(size, long_one, "left_anti")
        audits = audits.unionByName(by_conversation(short, lambda g, rows: [[0, *totals(rows), *g.edits("".join(r["symbols"] for r in rows))]], rounds, [T.StructField("piece", T.LongType()), *RESULTS]))
        if not size.isEmpty():
            audits = audits.unionByName(long_results(cut_ones.join(size, long_one, "left_semi"), rounds))
    every = (rows if ids is None else ids).select(F.col(f"`{conv}`").alias("conv")).distinct()
    return repaired(texts, audits, every).withColumnRenamed("conv", conv)


def damaged(rows: DataFrame) -> DataFrame:
    """conversations with faults put in by a checksum of conversation and turn: rows dropped, emptied, cut, repeated, or said by the user."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn"))), F.lit(20))
    text = F.when(F.col("__k") == 1, "").when(F.col("__k") == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    role = F.when(F.col("__k") == 4, "user").otherwise(said("role"))
    marked = rows.select("conv_id", "turn", "role", "text", k.alias("__k")).filter("__k != 0")
    copies = F.explode(F.when(F.col("__k") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return marked.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("__copy")).drop("__copy")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The repair of every conversation after the damage. Odd rows as `repair_conversations` says."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_conversations(damaged(rows), rows)
