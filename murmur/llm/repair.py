"""Structure of conversations: faults found and repaired by cheapest edits, long conversations in parallel chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import BLANKS, prepare, settled

#: Rows and characters of a chunk at most, besides the rest of its last row.
CHUNK_ROWS, CHUNK_CHARS = 4096, 4 << 20
#: What edits cost: delete, insert, rerole; and what an undeleted truncated row adds.
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5
#: A row's code is its role's initial and four times its fault.
INITIALS = {"s": 0, "u": 1, "a": 2}
OTHER, CLEAN, BLANK, DUPLICATE, TRUNCATED = 3, 0, 1, 2, 3
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: States of what is written so far: nothing, a system row, a user row last, an assistant row last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that a user or assistant row leads to; the only one of both that may stand there.
NEXT = (USER, USER, ASSISTANT, USER)
#: Costs to the end of a conversation from each state.
ENDED = (0, 2 * INSERT, INSERT, 0)


class Costs:
    """Backward steps over cost vectors and forward steps along the cheapest edits.

    A vector of costs counts only up to a constant. Differences between its states are
    bounded by a few edits, so there are few vectors; each step from one by a row's code is
    found once and then looked up.
    """

    def __init__(self):
        self.steps: dict[tuple, tuple] = {}
        self.moves: dict[tuple, tuple] = {}

    @staticmethod
    def _edits(code: int, after: tuple, state: int) -> list[tuple[str, int, int]]:
        """(letter, cost to the end, next state) of each edit of a row, in the order of their letters."""
        fault, initial = code >> 2, code & 3
        out = [("D", DELETE + after[state], state)]
        if fault in (BLANK, DUPLICATE):
            return out
        cut = CUT if fault == TRUNCATED else 0
        kept = SYSTEM if initial == 0 and state == START else NEXT[state] if initial == (2 if state == USER else 1) else None
        if kept is not None:
            out.append(("K", cut + after[kept], kept))
        return out + [("R", REROLE + cut + after[NEXT[state]], NEXT[state])]

    @staticmethod
    def _with_inserts(direct: list[int]) -> list[int]:
        # Two inserts in a row lead back to where they began, but for a user and an assistant at the start.
        user, assistant = min(direct[USER], INSERT + direct[ASSISTANT]), min(direct[ASSISTANT], INSERT + direct[USER])
        return [min(direct[START], INSERT + user), min(direct[SYSTEM], INSERT + user), user, assistant]

    def back(self, code: int, after: tuple) -> tuple[tuple, int]:
        """The vector before a row with its least cost taken off, and that cost."""
        key = code, after
        if key not in self.steps:
            costs = self._with_inserts([min(c for _, c, _ in self._edits(code, after, q)) for q in range(4)])
            self.steps[key] = tuple(c - min(costs) for c in costs), min(costs)
        return self.steps[key]

    def on(self, code: int, after: tuple, state: int) -> tuple[str, int]:
        """Letters of the inserts before a row and of its edit, least by ASCII of the cheapest; and the next state."""
        key = code, after, state
        if key not in self.moves:
            before, off = self.back(code, after)
            letters, q = "", state
            while True:
                cost = before[q] + off
                options = {letter: to for letter, c, to in self._edits(code, after, q) if c == cost}
                if "D" not in options and INSERT + before[NEXT[q]] + off == cost:
                    letters, q = letters + "I", NEXT[q]
                    continue
                letter = min(options)
                self.moves[key] = letters + letter, options[letter]
                break
        return self.moves[key]

    def backward(self, codes: bytes, after: tuple) -> tuple[list[tuple], int]:
        """The vector after each row, those before the first last, in backward order; and what was taken off in all."""
        vectors, off, steps = [after], 0, self.steps
        for code in reversed(codes):
            found = steps.get((code, after)) or self.back(code, after)
            after = found[0]
            off += found[1]
            vectors.append(after)
        return vectors, off

    def fix_up(self, codes: bytes, after: tuple, guess: tuple, outcome: tuple) -> tuple:
        """The vector before the first row from `after`, given `outcome` from another vector `guess`.

        Ends where both runs differ by a constant only, as from there on they are one.
        """
        for code in reversed(codes):
            if after == guess:
                return outcome
            after, guess = self.back(code, after)[0], self.back(code, guess)[0]
        return after

    def forward(self, codes: bytes, vectors: list[tuple], state: int) -> tuple[list[str], int]:
        letters, moves, n = [], self.moves, len(codes)
        for i, code in enumerate(codes):
            after = vectors[n - 1 - i]
            found = moves.get((code, after, state)) or self.on(code, after, state)
            letters.append(found[0])
            state = found[1]
        return letters, state


def finish(state: int) -> list[str]:
    """Roles to insert at the end."""
    return {SYSTEM: ["user", "assistant"], USER: ["assistant"]}.get(state, [])


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and dropped, with every row damaged by the checksum of its conv_id and turn.

    By crc32(`conv_id:turn`) % 20: 0 drops a row, which stays here as one without turn, role
    and text, so that its conversation is told of; 1 empties its text, 2 removes its [.!?],
    3 repeats it, 4 makes its role user. Nulls are one space, but a null turn stays one.
    """
    def said(name: str):
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))
    case = F.crc32(F.encode(F.concat(said("conv_id"), F.lit(":"), said("turn")), "UTF-8")) % 20
    text = F.when(F.col("case") == 1, "").when(F.col("case") == 2, F.translate(said("text"), ".!?", "")).otherwise(said("text"))
    rows = conversations.select("conv_id", "turn", "role", "text", case.alias("case"))
    dropped = F.col("case") == 0
    rows = rows.select("conv_id", F.when(~dropped, F.col("turn")).alias("turn"),
                       F.when(~dropped, F.when(F.col("case") == 4, "user").otherwise(said("role"))).alias("role"),
                       F.when(~dropped, text).alias("text"), dropped.alias("dropped"), "case")
    return rows.select("conv_id", "turn", "role", "text", "dropped", F.explode(
        F.when(F.col("case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy")).drop("_copy")


class Chunk:
    """Rows of one conversation that follow each other, with what is known of them by themselves."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.codes, self.roles, self.texts, self.keys = bytearray(), [], [], []
        self.seen: set = set()
        self.low = self.high = None
        self.turns = self.chars = 0

    def add(self, turn, role: str, text: str) -> None:
        said = text.rstrip(BLANKS)
        key = role, text
        fault = BLANK if not said else DUPLICATE if key in self.seen else CLEAN if said[-1] in ".!?" else TRUNCATED
        self.keys.append(key if key not in self.seen and said else None)
        self.seen.add(key)
        self.codes.append(INITIALS.get(role[:1], OTHER) + 4 * fault)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)
        if turn is not None:  # rows come by turn
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn

    def full(self) -> bool:
        return len(self.codes) >= CHUNK_ROWS or self.chars >= CHUNK_CHARS

    def digests(self) -> list[bytes | None]:
        """128 bits for each role and text that is new in the chunk; null for blank rows and repeats."""
        return [k and hashlib.blake2b(f"{len(k[0])}:{k[0]}{k[1]}".encode(), digest_size=16).digest() for k in self.keys]


def faults_of(codes: bytes) -> tuple[int, int, int, int]:
    """Blank, duplicate and truncated rows, and neighbours that may not follow each other."""
    faults = [c >> 2 for c in codes]
    initials = [c & 3 for c in codes]
    return (faults.count(BLANK), faults.count(DUPLICATE), faults.count(TRUNCATED),
            sum(pair not in LEGAL for pair in zip(initials, initials[1:])))


def repaired(letters: Iterable[str], roles: list[str], texts: list[str], state: int) -> list[str]:
    """`role:text` of what the edits write, from `state` on."""
    lines, rows = [], zip(roles, texts)
    names = {USER: "user", ASSISTANT: "assistant"}
    for letter in "".join(letters):
        role, text = ("", "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        state = SYSTEM if letter == "K" and role[:1] == "s" else NEXT[state]
        lines.append(f"{role if letter == 'K' else names[state]}:{text}")
    return lines


def cost_of(letters: Iterable[str], codes: bytes) -> int:
    total = 0
    for edits, code in zip(letters, codes):
        total += INSERT * (len(edits) - 1)
        total += DELETE if edits[-1] == "D" else REROLE * (edits[-1] == "R") + CUT * (code >> 2 == TRUNCATED)
    return total


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _told(chunk: Chunk, costs: Costs) -> tuple:
    """gaps to cost, audit and digest of a conversation that is one chunk."""
    codes = bytes(chunk.codes)
    vectors, off = costs.backward(codes, ENDED)
    letters, state = costs.forward(codes, vectors, START)
    lines = repaired(letters, chunk.roles, chunk.texts, START) + [f"{r}:" for r in finish(state)]
    gaps = 0 if chunk.low is None else chunk.high - chunk.low + 1 - chunk.turns
    audit = "".join(letters) + "I" * len(finish(state))
    return (gaps, *faults_of(codes), vectors[-1][START] + off, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


OPEN = ("part int, chunk int, codes binary, keys array<binary>, roles array<string>, texts array<string>, low long, high long, turns long")
DONE = ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"


def _first_pass(rows: DataFrame) -> DataFrame:
    """DONE for conversations that one task has whole, and OPEN chunks of those that it may not have.

    Rows come range-partitioned by conversation and turn. A task has all of a conversation
    but those its range begins and ends with; these, and those of more than a chunk, are open.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    names = ["conv_id", *[f.split()[0] for f in (OPEN + ", " + DONE).split(", ")]]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(),
             pa.int64(), pa.int64(), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, costs, chunk, n, whole = TaskContext.get().partitionId(), Costs(), None, 0, False
        done: list[tuple] = []

        def batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), [of_id, *kinds])], names)

        def opened(own: Chunk) -> pa.RecordBatch:
            nonlocal n
            n += 1
            return batch([(own.conv_id, part, n, bytes(own.codes), own.digests(), own.roles, own.texts, own.low, own.high, own.turns,
                           *[None] * (len(COUNTS) + 2))])
        for b in batches:
            of_id = b.column(0).type
            for conv_id, turn, role, text, dropped in zip(*[c.to_pylist() for c in b.columns]):
                if chunk is None or conv_id != chunk.conv_id:
                    if chunk is not None:
                        if whole:
                            done.append((chunk.conv_id, *[None] * 9, *_told(chunk, costs)))
                        else:
                            yield opened(chunk)
                    whole, chunk = chunk is not None, Chunk(conv_id)
                if not dropped:
                    if chunk.full():
                        yield opened(chunk)
                        whole, chunk = False, Chunk(conv_id)
                    chunk.add(turn, role, text)
            if done:
                yield batch(done)
                done = []
        if chunk is not None:
            yield opened(chunk)
    return rows.mapInArrow(split, f"conv_id {id_type}, {OPEN}, {DONE}")


def _coded(codes: bytes, late: list[int] | None) -> bytes:
    """The codes of a chunk with rows at `late`, which repeat an earlier chunk's, as duplicates."""
    own = bytearray(codes)
    for at in late or ():
        own[at] = own[at] & 3 | DUPLICATE << 2
    return bytes(own)


def _packed(vector: tuple) -> str:
    return ",".join(map(str, vector))


def _unpacked(vector: str) -> tuple:
    return tuple(map(int, vector.split(",")))


def _by_conversation(rows: DataFrame, *order) -> DataFrame:
    """Rows of a conversation in one task, which streams them: a row stands for a chunk, so they are few."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "conv_id").sortWithinPartitions("conv_id", *order)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _emitted(rows: Iterable[tuple], schema: pa.Schema, most: int = 4096, weight=lambda row: 1) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


PLACE = [("part", pa.int32()), ("chunk", pa.int32())]


def end_vectors(chunks: DataFrame) -> DataFrame:
    """part, chunk and the vector after each chunk's last row, by speculation and fix-up passes.

    Every chunk runs backward from the vector of a conversation's end, all at the same time.
    Then each conversation's chunks are gone through from its last: a chunk whose true end
    vector was not tried yet is run again from it, all such chunks at the same time, and
    that until none is left. A run ends where its vectors differ from an earlier run's by
    constants only. Where chunks forget their end, as they do in conversations that are
    anything like legal, one fix-up is enough; else every outcome tried is remembered, and as
    there are few vectors, few passes follow even along the longest conversation.
    """
    known_type = pa.schema([*PLACE, ("guess", pa.string()), ("outcome", pa.string())])
    wanted_type = pa.schema([*PLACE, ("vector", pa.string()), ("tried", pa.bool_()), ("guess", pa.string()), ("outcome", pa.string())])

    def speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        yield from _emitted(((r["part"], r["chunk"], _packed(ENDED), _packed(costs.backward(_coded(r["codes"], r["late"]), ENDED)[0][-1]))
                             for r in _rows(batches)), known_type)

    def stitch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walk() -> Iterator[tuple]:
            conv, vector = object(), None
            for r in _rows(batches):
                if r["conv_id"] != conv:
                    conv, vector = r["conv_id"], _packed(ENDED)
                outcomes = {k["guess"]: k["outcome"] for k in r["known"]}
                some = min(outcomes)
                yield r["part"], r["chunk"], vector, vector in outcomes, some, outcomes[some]
                vector = outcomes.get(vector, outcomes[some])
        yield from _emitted(walk(), wanted_type)

    def fix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        yield from _emitted(((r["part"], r["chunk"], r["vector"], _packed(costs.fix_up(
            _coded(r["codes"], r["late"]), *map(_unpacked, (r["vector"], r["guess"], r["outcome"]))))) for r in _rows(batches)), known_type)
    known_ddl = "part int, chunk int, guess string, outcome string"
    known = settled(chunks.select("part", "chunk", "codes", "late").mapInArrow(speculate, known_ddl), "known")
    while True:
        outcomes = known.groupBy("part", "chunk").agg(F.collect_list(F.struct("guess", "outcome")).alias("known"))
        placed = chunks.select("conv_id", "part", "chunk").join(outcomes, ["part", "chunk"])
        walked = settled(_by_conversation(placed, F.desc("part"), F.desc("chunk")).mapInArrow(
            stitch, "part int, chunk int, vector string, tried boolean, guess string, outcome string"), "walked")
        if walked.where(~F.col("tried")).isEmpty():
            return walked.select("part", "chunk", "vector")
        more = chunks.select("part", "chunk", "codes", "late").join(walked.where(~F.col("tried")), ["part", "chunk"])
        known = known.unionAll(settled(more.mapInArrow(fix, known_ddl), "known"))


def _entries(chunks: DataFrame) -> DataFrame:
    """part, chunk and the state its first row meets, from each chunk's exits for every state it may begin with."""
    out = pa.schema([*PLACE, ("exits", pa.list_(pa.int32()))])

    def exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()

        def rows() -> Iterator[tuple]:
            for r in _rows(batches):
                codes = _coded(r["codes"], r["late"])
                vectors = costs.backward(codes, _unpacked(r["vector"]))[0]
                yield r["part"], r["chunk"], [costs.forward(codes, vectors, q)[1] for q in range(4)]
        yield from _emitted(rows(), out)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def walk() -> Iterator[tuple]:
            conv, state = object(), START
            for r in _rows(batches):
                if r["conv_id"] != conv:
                    conv, state = r["conv_id"], START
                yield r["part"], r["chunk"], state
                state = r["exits"][state]
        yield from _emitted(walk(), pa.schema([*PLACE, ("state", pa.int32())]))
    left = chunks.select("part", "chunk", "codes", "late", "vector").mapInArrow(exits, "part int, chunk int, exits array<int>")
    placed = chunks.select("conv_id", "part", "chunk").join(settled(left, "exits"), ["part", "chunk"])
    return _by_conversation(placed, "part", "chunk").mapInArrow(enter, "part int, chunk int, state int")


def _open_conversations(found: DataFrame) -> DataFrame:
    """conv_id and DONE of the conversations whose chunks lie in several tasks or are several."""
    opened = found.where(F.col("part").isNotNull())
    keyed = opened.select("conv_id", "part", "chunk", F.posexplode("keys").alias("at", "key")).where(F.col("key").isNotNull())
    # A key is there once in a chunk, so there are at most as many of one as chunks.
    nth = F.row_number().over(Window.partitionBy("conv_id", "key").orderBy("part", "chunk"))
    late = (keyed.withColumn("nth", nth).where("nth > 1").groupBy("part", "chunk").agg(F.collect_list("at").alias("late")))
    chunks = settled(opened.select("conv_id", "part", "chunk", "codes").join(settled(late, "late"), ["part", "chunk"], "left"), "chunks")
    chunks = settled(chunks.join(end_vectors(chunks), ["part", "chunk"]), "ended")
    entered = settled(_entries(chunks), "entered")
    id_type = found.schema["conv_id"].dataType.simpleString()
    piece_ddl = (f"conv_id {id_type}, part int, chunk int, low long, high long, turns long, counts array<bigint>, first int, last int, "
                 "audit string, n_lines long, lines string, state int")

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = Costs()
        for b in batches:
            kinds = [b.column("conv_id").type, pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int32(),
                     pa.int32(), pa.string(), pa.int64(), pa.string(), pa.int32()]
            for r in b.to_pylist():
                codes = _coded(r["codes"], r["late"])
                letters, state = costs.forward(codes, costs.backward(codes, _unpacked(r["vector"]))[0], r["state"])
                lines = repaired(letters, r["roles"], r["texts"], r["state"])
                row = (r["conv_id"], r["part"], r["chunk"], r["low"], r["high"], r["turns"], [*faults_of(codes), cost_of(letters, codes)],
                       codes[0] & 3 if codes else None, codes[-1] & 3 if codes else None, "".join(letters), len(lines), "\n".join(lines), state)
                yield pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(row, kinds)], [f.split()[0] for f in piece_ddl.split(", ")])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each conversation from its pieces in their order: a digest and counters are all that is held, and the audit."""
        schema = None

        def walk(rows: Iterator[dict]) -> Iterator[tuple]:
            conv, own = None, None
            for r in rows:
                if own is None or r["conv_id"] != conv:
                    if own is not None:
                        yield (conv, *own.told())
                    conv, own = r["conv_id"], _Joined()
                own.add(r)
            if own is not None:
                yield (conv, *own.told())
        first = next(batches, None)
        if first is not None:
            schema = pa.schema([("conv_id", first.schema.field("conv_id").type), *[(c, pa.int64()) for c in COUNTS],
                                ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield from _emitted(walk(r for b in (iter([first]), batches) for r in _rows(b)), schema)
    plans = chunks.select("part", "chunk", "late", "vector").join(entered, ["part", "chunk"])
    full = opened.select("conv_id", *[f.split()[0] for f in OPEN.split(", ")]).drop("keys").join(settled(plans, "plans"), ["part", "chunk"])
    return _by_conversation(full.mapInArrow(trace, piece_ddl), "part", "chunk").mapInArrow(join, f"conv_id {id_type}, {DONE}")


class _Joined:
    """A conversation as its pieces come."""

    def __init__(self):
        self.counts, self.audit, self.digest, self.n_lines = [0] * 5, [], hashlib.sha256(), 0
        self.low = self.high = self.last = None
        self.turns, self.state = 0, START

    def _write(self, lines: str, n: int) -> None:
        if n:
            self.digest.update(("\n" if self.n_lines else "").encode() + lines.encode())
            self.n_lines += n

    def add(self, r: dict) -> None:
        self.counts = [a + b for a, b in zip(self.counts, r["counts"])]
        if r["first"] is not None:
            if self.last is not None and (self.last, r["first"]) not in LEGAL:
                self.counts[3] += 1
            self.last = r["last"]
        if r["low"] is not None:
            self.turns += r["turns"] - (r["low"] == self.high)
            self.low, self.high = r["low"] if self.low is None else self.low, r["high"]
        self.audit.append(r["audit"])
        self._write(r["lines"], r["n_lines"])
        self.state = r["state"]

    def told(self) -> tuple:
        ending = finish(self.state)
        self._write("\n".join([f"{r}:" for r in ending]), len(ending))
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts[:4], self.counts[4] + INSERT * len(ending), "".join(self.audit) + "I" * len(ending), self.digest.hexdigest())


def repair(rows: DataFrame) -> DataFrame:
    """conv_id and DONE for each conversation of rows (conv_id, turn, role, text, dropped).

    A row's first fault counts: blank, duplicate (role and text stand in an earlier row),
    truncated. Keeping a row is free, a new role costs 1, deleting 2 (blank and duplicate rows
    must go), an empty row put in 5, and a truncated row that stays 5; the cheapest edits
    that leave `(s?(ua)+)?` by the roles' initials are taken, of equals those whose initials
    are least in ASCII. Rows of one turn stand by role and text; rows without turn stand
    first, repeated rows beside each other; a null conv_id is a conversation. A conversation
    whose rows are all dropped has zeros, no audit and the digest of nothing; an empty table
    has none. Role and text are not null where a row is not dropped.

    Rows are range-partitioned by all their columns and the task they come from, so neither a
    conversation nor equal rows of a third of the table meet in one task. What a task can't
    have whole goes on in chunks; see `end_vectors`. Of such a conversation one task streams
    the repaired chunks, as its digest is that of one text.
    """
    spark = rows.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv_id", "turn", "role", "text", "_from"]
    ranged = rows.withColumn("_from", F.spark_partition_id()).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    found = settled(_first_pass(ranged.select("conv_id", "turn", "role", "text", "dropped")), "repaired")
    done = [f.split()[0] for f in DONE.split(", ")]
    return found.where(F.col("part").isNull()).select("conv_id", *done).unionAll(_open_conversations(found))


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """`repair` of `damage`d rows (conv_id, turn, role, text); other columns are not read."""
    return repair(damage(conversations))
