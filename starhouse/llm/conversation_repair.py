"""Repair of conversation structure by rank-convergence parallel Viterbi.

A conversation is sound when the initials of its roles read ``(s?(ua)+)?``. Its rows are kept
(cost 0), given the role user or assistant (2) or deleted (3; blank rows and repeats must be),
empty rows of user or assistant are inserted (2), and each truncated row that stays adds 1. Of
the cheapest edits those whose initials D, I, K, R read least in ASCII order are taken.

The edits are a shortest path over four states (nothing yet, after s, after u, after a). Rows
are numbered in order and cut into chunks of ``CHUNK_ROWS``, a byte a row. Backward costs are
vectors over the states of which only differences matter: every chunk starts from a speculative
vector at its right end, and fix-up passes give it the vector its neighbour has found and
rerun it until old and new vectors differ only by a constant, from where on the old result
holds. The stitched vectors then drive the tracing forward, which speculates on the state it
enters with and is fixed up alike. Some inputs never converge (a run of system rows keeps a
difference for ever), so later passes rerun longer stretches of neighbouring chunks in order:
the number of passes stays small for a conversation of any length.

Only ids, turns, roles and digests are numbered and chunked. Text moves once, to the pass that
writes a conversation out in order; this is a stream, which keeps the letters of the edits (the
audit, a letter a row) and no text. A digest of a whole conversation is sequential by nature,
so there, and only there, one task reads all rows of a conversation.

Defined results: null role and text are one space; rows are taken by turn (nulls first), then
role, then md5 of the text; a null conv_id is a conversation; a role is kept where its initial
is s, u or a (an empty role has none); rows equal in all four columns are rows like others;
no rows give no conversation. Only conv_id, turn, role and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starhouse.llm.common import joined_evenly, stored
from starhouse.operators.ordering import with_global_index

CHUNK_ROWS = 256
#: Rows of one stretch at most, and by how much stretches grow from pass to pass.
STRETCH_ROWS = 1 << 20
GROWTH = 16
RETYPE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1

#: States: nothing yet, after s, after u, after a. What follows a kept initial, and an inserted or retyped row.
_KEPT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
_MADE = {0: 2, 1: 2, 2: 3, 3: 2}
_TAIL = {0: "", 1: "II", 2: "I", 3: ""}
_PRICE = {"K": 0, "R": RETYPE, "D": DELETE, "I": INSERT}
_END = tuple(INSERT * len(_TAIL[s]) for s in range(4))
_GUESS = (0, 0, 0, 0)
_GONE = "x"

_COUNTS = ("blank", "duplicate", "truncated", "cost")

Vector = tuple[int, int, int, int]


def _step(after: Vector, symbol: str) -> list[list[tuple[int, str, int]]]:
    """For each state before a row: cost to the end, letter and next state of every way on."""
    ways: list[list[tuple[int, str, int]]] = [[(DELETE + after[s], "D", s)] for s in range(4)]
    if symbol != _GONE:
        cut = TRUNCATED if symbol.isupper() else 0
        for s in range(4):
            if (kept := _KEPT[symbol.lower()].get(s)) is not None:
                ways[s].append((cut + after[kept], "K", kept))
            ways[s].append((RETYPE + cut + after[_MADE[s]], "R", _MADE[s]))
    best = [min(w)[0] for w in ways]
    for _ in range(3):
        best = [min(best[s], INSERT + best[_MADE[s]]) for s in range(4)]
    for s in range(4):
        ways[s].append((INSERT + best[_MADE[s]], "I", _MADE[s]))
        ways[s] = [w for w in ways[s] if w[0] == best[s]]
    return ways


class Viterbi:
    """Steps over rows; vectors are kept less their least entry, of which there are few."""

    def __init__(self) -> None:
        self.vectors: dict[tuple[Vector, str], Vector] = {}
        self.moves: dict[tuple[Vector, str, int], tuple[str, int]] = {}

    def before(self, after: Vector, symbol: str) -> Vector:
        key = (after, symbol)
        if key not in self.vectors:
            costs = [w[0][0] for w in _step(after, symbol)]
            self.vectors[key] = tuple(c - min(costs) for c in costs)
        return self.vectors[key]

    def move(self, after: Vector, symbol: str, state: int) -> tuple[str, int]:
        """The least letters that use up a row, and the state they lead to."""
        key = (after, symbol, state)
        if key not in self.moves:
            ways, letters, s = _step(after, symbol), "", state
            while not letters or letters[-1] == "I":
                _, letter, s = min(ways[s], key=lambda w: w[1])
                letters += letter
            self.moves[key] = letters, s
        return self.moves[key]

    def backward(self, symbols: str, right: Vector, old_right: Vector | None, old_left: Vector | None) -> Vector:
        """The vector before a chunk; the old one from where the rerun agrees with the old run."""
        new, old = right, old_right
        for symbol in reversed(symbols):
            new = self.before(new, symbol)
            if old is not None and (old := self.before(old, symbol)) == new:
                return old_left
        return new

    def after(self, symbols: str, right: Vector) -> list[Vector]:
        """The vector after each row of a chunk."""
        out = [right]
        for symbol in reversed(symbols[1:]):
            out.append(self.before(out[-1], symbol))
        return out[::-1]

    def forward(self, symbols: str, right: Vector, state: int, old: int | None, old_exit: int | None) -> int:
        """The state after a chunk; the old one from where both paths meet."""
        for symbol, after in zip(symbols, self.after(symbols, right)):
            state = self.move(after, symbol, state)[1]
            if old is not None and (old := self.move(after, symbol, old)[1]) == state:
                return old_exit
        return state

    def letters(self, symbols: str, right: Vector, state: int, last: bool) -> tuple[str, int]:
        """The edits of a chunk and their cost."""
        out, stay_cut = [], 0
        for symbol, after in zip(symbols, self.after(symbols, right)):
            move, state = self.move(after, symbol, state)
            stay_cut += symbol.isupper() and move[-1] != "D"
            out.append(move)
        text = "".join(out) + (_TAIL[state] if last else "")
        return text, TRUNCATED * stay_cut + sum(_PRICE[x] for x in text)


def _text_of(vector: Vector) -> str:
    return ",".join(map(str, vector))


def _vector_of(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


class _Backward:
    """Given and result of a chunk are the vectors at its right and left end."""

    towards = -1
    boundary, guess = _text_of(_END), _text_of(_GUESS)

    @staticmethod
    def run(viterbi: Viterbi, row, given: str, old_given: str | None = None, old_result: str | None = None) -> str:
        old = (_vector_of(old_given), _vector_of(old_result)) if old_given else (None, None)
        return _text_of(viterbi.backward(row.symbols, _vector_of(given), *old))


class _Forward:
    """Given and result of a chunk are the states before and after it; ``right`` holds its vector."""

    towards = 1
    boundary, guess = "0", "3"

    @staticmethod
    def run(viterbi: Viterbi, row, given: str, old_given: str | None = None, old_result: str | None = None) -> str:
        old = (int(old_given), int(old_result)) if old_given else (None, None)
        return str(viterbi.forward(row.symbols, _vector_of(row.right), int(given), *old))


def _speculated(chunks: DataFrame, phase: type) -> DataFrame:
    """Adds ``given`` (true at the end where the phase begins, else a guess) and ``result``."""
    begins = F.col("last" if phase.towards < 0 else "first")
    chunks = chunks.withColumn("given", F.when(begins, phase.boundary).otherwise(phase.guess))
    schema = f"{chunks.schema.toDDL()}, result string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        viterbi = Viterbi()
        for batch in batches:
            batch["result"] = [phase.run(viterbi, row, row.given) for row in batch.itertuples(index=False)]
            yield batch

    return chunks.mapInPandas(run, schema)


def _with_near(chunks: DataFrame, phase: type) -> DataFrame:
    """Adds ``near``, what the neighbour now says ``given`` should be (null at the end)."""
    near = chunks.select("_conv", (F.col("_chunk") + phase.towards).alias("_chunk"), F.col("result").alias("near"))
    return chunks.join(near, ["_conv", "_chunk"], "left")


def _rerun(chunks: DataFrame, phase: type, width: int) -> DataFrame:
    """One fix-up pass: stretches of ``width`` chunks, each in order from what lies beside it."""
    schema, columns = chunks.schema.toDDL(), chunks.columns

    def run(stretch: pd.DataFrame) -> pd.DataFrame:
        viterbi, found, results = Viterbi(), None, []
        stretch = stretch.sort_values("_chunk", ascending=phase.towards > 0)
        for row in stretch.itertuples(index=False):
            given = found if found is not None else row.near if isinstance(row.near, str) else row.given
            found = row.result if given == row.given else phase.run(viterbi, row, given, row.given, row.result)
            results.append((given, found))
        stretch["given"], stretch["result"] = zip(*results)
        return stretch[columns]

    groups = _with_near(chunks, phase).groupBy("_conv", F.expr(f"_chunk div {width}"))
    return groups.applyInPandas(run, schema)


def _settled(chunks: DataFrame, phase: type, label: str, chunk_rows: int) -> DataFrame:
    """``given`` and ``result`` of all chunks after as many fix-up passes as it takes."""
    start = stored(_speculated(chunks, phase), label)
    whole = F.col("first") & F.col("last")
    several, width = start.filter(~whole), 1
    while _with_near(several, phase).filter("near <> given").limit(1).count():
        width = min(width * GROWTH, max(1, STRETCH_ROWS // chunk_rows))
        several = stored(_rerun(several, phase, width), f"{label}-again")
    return start.filter(whole).unionByName(several)


def _text_order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("_digest")]


def _keyed(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text without nulls in the last two, a key without null, and the text's digest."""
    space = F.lit(" ")
    return rows.select(
        "conv_id",
        F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("-")).alias("_conv"),
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
    ).withColumn("_digest", F.unhex(F.md5("text")))


def edits(keyed: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A row a chunk: _conv, _chunk, letters (in order of the chunk's rows), their cost and counts of faults."""
    end = F.substring(F.rtrim("text", F.lit(" \t\n\x0b\f\r")), -1, 1)
    role = F.substring("role", 1, 1)
    narrow = keyed.select(
        "_conv",
        "turn",
        "role",
        "_digest",
        (~F.col("text").rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        F.when(role.isin("s", "u", "a"), role).otherwise("o").alias("symbol"),
        (~end.isin(".", "!", "?")).alias("cut"),
        F.rand(13).alias("_tie"),
    )
    numbered = stored(with_global_index(narrow, [F.col("_conv"), *_text_order(), F.col("_tie")], "_n"), "conversation-rows")
    seen = numbered.groupBy("_conv", "role", "_digest").agg(F.count("*").alias("_size"), F.min("_n").alias("_first"))
    seen = stored(seen.filter("_size > 1"), "conversation-repeats")
    rows = joined_evenly(numbered, seen, ["_conv", "role", "_digest"], "_size")
    repeat = ~F.col("blank") & (F.coalesce("_first", F.col("_n")) < F.col("_n"))
    cut = ~F.col("blank") & ~repeat & F.col("cut")
    symbol = F.when(F.col("blank") | repeat, _GONE).when(cut, F.upper("symbol")).otherwise(F.col("symbol"))
    rows = rows.select(
        "_conv", "_n", F.expr(f"_n div {chunk_rows}").alias("_chunk"), symbol.alias("s"),
        F.col("blank").cast("int").alias("b"), repeat.cast("int").alias("d"), cut.cast("int").alias("t"),
    )
    in_order = F.sort_array(F.collect_list(F.struct("_n", "s")))
    chunks = rows.groupBy("_conv", "_chunk").agg(
        F.concat_ws("", F.transform(in_order, lambda x: x["s"])).alias("symbols"),
        *[F.sum(c).alias(name) for c, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
    )
    chunks = stored(chunks, "conversation-chunks")
    for name, aside in (("first", 1), ("last", -1)):
        beside = chunks.select("_conv", (F.col("_chunk") + aside).alias("_chunk"), F.lit(True).alias("beside"))
        chunks = chunks.join(beside, ["_conv", "_chunk"], "left").withColumn(name, F.col("beside").isNull()).drop("beside")

    back = _settled(chunks, _Backward, "conversation-costs", chunk_rows)
    ready = back.withColumnRenamed("given", "right").drop("result")
    traced = _settled(ready, _Forward, "conversation-states", chunk_rows)

    @F.pandas_udf("letters string, cost bigint")
    def letters(symbols: pd.Series, right: pd.Series, given: pd.Series, last: pd.Series) -> pd.DataFrame:
        viterbi = Viterbi()
        rows = zip(symbols, right, given, last)
        found = [viterbi.letters(s, _vector_of(r), int(g), e) for s, r, g, e in rows]
        return pd.DataFrame(found, columns=["letters", "cost"])

    audit = letters("symbols", "right", "given", "last").alias("audit")
    return traced.select("_conv", "_chunk", audit, "blank", "duplicate", "truncated").select(
        "_conv", "_chunk", "audit.letters", "audit.cost", *_COUNTS[:-1]
    )


def _in_order(keyed: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunks and, after them, rows of each conversation in order, one conversation in one partition."""
    chunks = edits(keyed.filter("_kind = 1"), chunk_rows).withColumn("_kind", F.lit(0))
    both = keyed.unionByName(chunks, allowMissingColumns=True)
    order = [F.col("_conv"), F.col("_kind"), F.col("_chunk"), *_text_order()]
    return both.repartition("_conv").sortWithinPartitions(*order).select(
        "_conv", "_kind", "conv_id", "turn", "role", "text", "letters", *_COUNTS
    )


class _Conversation:
    """What the stream carries of the conversation it is in."""

    def __init__(self, conv: str):
        self.conv, self.conv_id = conv, None
        self.pieces: list[str] = []
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.audit, self.at, self.state = "", 0, 0
        self.turns: list[int] = []
        self.distinct, self.illegal, self.before = 0, 0, None
        self.hash, self.empty = hashlib.sha256(), True

    def made(self) -> str:
        self.state = _MADE[self.state]
        return "user" if self.state == 2 else "assistant"

    def inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self.made(), "", "I"

    def row(self, turn: int | None, role: str, text: str) -> Iterator[tuple[str, str, str]]:
        """The repaired rows that a row gives, with what comes before it."""
        if self.pieces:
            self.audit, self.pieces = "".join(self.pieces), []
        if turn is not None and (not self.turns or turn != self.turns[-1]):
            self.turns = [*self.turns[:1], turn]
            self.distinct += 1
        if self.before is not None and self.before[:1] + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = role
        yield from self.inserted()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "K":
            self.state = _KEPT[role[0]][self.state]
            yield role, text, letter
        elif letter == "R":
            yield self.made(), text, letter

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False

    def summary(self) -> dict:
        for role, text, _ in self.inserted():
            self.add(role, text)
        gaps = self.turns[-1] - self.turns[0] + 1 - self.distinct if self.turns else 0
        return {
            "conv_id": self.conv_id, "gaps": gaps, **self.counts, "illegal": self.illegal,
            "audit": self.audit, "repaired_sha256": self.hash.hexdigest(),
        }


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*[batch.column(c).to_pylist() for c in ("_conv", "_kind", "conv_id", "turn", "role", "text", "letters", *_COUNTS)])


def report(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """A row for each conv_id with counts of faults, the cost, the audit and the repaired text's digest.

    A column ``dropped``, if there is one, marks rows that count for nothing but their conv_id.
    """
    fields = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
    keyed = _keyed_with_dropped(conversations)
    schema = f"conv_id {keyed.schema['conv_id'].dataType.simpleString()}, {fields}"
    arrow = keyed.select("conv_id").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        out = pa.schema([("conv_id", to_arrow_type(arrow["conv_id"].dataType))]
                        + [(f.split()[0], pa.string() if f.endswith("string") else pa.int64()) for f in fields.split(", ")])
        now = None
        for batch in batches:
            done = []
            for conv, kind, conv_id, turn, role, text, letters, *counts in _columns(batch):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.summary())
                    now = _Conversation(conv)
                if kind == 0:
                    now.pieces.append(letters)
                    for name, n in zip(_COUNTS, counts):
                        now.counts[name] += n
                    continue
                now.conv_id = conv_id
                if kind == 1:
                    for kept in now.row(turn, role, text):
                        now.add(kept[0], kept[1])
            yield pa.RecordBatch.from_pylist(done, schema=out)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.summary()], schema=out)

    return _in_order(keyed, chunk_rows).mapInArrow(run, schema)


def _keyed_with_dropped(rows: DataFrame) -> DataFrame:
    if "dropped" not in rows.columns:
        return _keyed(rows).withColumn("_kind", F.lit(1))
    gone = _keyed(rows.filter("dropped").withColumn("text", F.lit(""))).withColumn("_kind", F.lit(2))
    return _keyed(rows.filter("NOT dropped")).withColumn("_kind", F.lit(1)).unionByName(gone)


def repaired(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """The repaired rows: conv_id, place (from 0), edit (K, R or I), role and text."""
    keyed = _keyed_with_dropped(conversations)
    kind = keyed.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        names = ["conv_id", "place", "edit", "role", "text"]
        out = pa.schema(list(zip(names, [to_arrow_type(kind), pa.int64(), pa.string(), pa.string(), pa.string()])))
        now, place = None, 0
        for batch in batches:
            done: list[tuple] = []
            for conv, kind_, conv_id, turn, role, text, letters, *_ in _columns(batch):
                if now is None or conv != now.conv:
                    rest = now.inserted() if now is not None else ()
                    done += [(now.conv_id, place + i, e, r, t) for i, (r, t, e) in enumerate(rest)]
                    now, place = _Conversation(conv), 0
                if kind_ == 0:
                    now.pieces.append(letters)
                elif kind_ == 1:
                    now.conv_id = conv_id
                    for r, t, e in now.row(turn, role, text):
                        done.append((conv_id, place, e, r, t))
                        place += 1
            yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in done], schema=out)
        if now is not None:
            rest = [(now.conv_id, place + i, e, r, t) for i, (r, t, e) in enumerate(now.inserted())]
            yield pa.RecordBatch.from_pylist([dict(zip(names, d)) for d in rest], schema=out)

    schema = f"conv_id {kind.simpleString()}, place bigint, edit string, role string, text string"
    return _in_order(keyed, chunk_rows).mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with planted faults, by crc32 of ``conv_id:turn`` modulo 20; a ``dropped`` row stays as a mark."""
    space = F.lit(" ")
    parts = [F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")]
    fault = F.pmod(F.crc32(F.encode(F.concat_ws(":", *parts), "UTF-8")), F.lit(20))
    text = F.coalesce("text", space)
    changed = F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    twice = F.explode(F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.withColumn("_fault", fault).select(
        "conv_id",
        "turn",
        F.when(F.col("_fault") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        changed.alias("text"),
        (F.col("_fault") == 0).alias("dropped"),
        twice.alias("copy"),
    )


def oracle() -> str:
    """The same by dynamic programming from the front: least cost, then least audit, for each state."""

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"

    def way(source: str, cost: str, letter: str, piece: str | None) -> str:
        text = f"{source}.t" if piece is None else f"{source}.t || CASE WHEN {source}.t = '' THEN '' ELSE chr(10) END || {piece}"
        return f"CASE WHEN {source} IS NOT NULL THEN {{'c': {source}.c + {cost}, 'a': {source}.a || '{letter}', 't': {text}}} END"

    cut = "CASE WHEN r.truncated THEN 1 ELSE 0 END"

    def after(state: str, keep: str, sources: tuple[str, ...], made: str | None, made_from: tuple[str, ...]) -> str:
        ways = [way(f"p.{state}", "3", "D", None)]
        ways += [f"CASE WHEN r.stays AND r.initial = '{keep}' THEN {way(f'p.{x}', cut, 'K', 'r.role || chr(58) || r.text')} END" for x in sources]
        ways += [f"CASE WHEN r.stays THEN {way(f'p.{x}', f'2 + {cut}', 'R', f'{chr(39)}{made}:{chr(39)} || r.text')} END" for x in made_from]
        return f"{least(*ways)} AS {state}"

    def inserted(source: str) -> str:
        first = least("p.u", *[way(f"p.{x}", "2", "I", "'user:'") for x in ("n", "s", "a")])
        return f"SELECT id, i, n, s, {first} AS u, {least('p.a', way('p.u', '2', 'I', chr(39) + 'assistant:' + chr(39)))} AS a FROM {source} p"

    nothing = "CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR))"
    return f"""
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda n: list_reduce(range(8),
        lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS tab
), hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce('=' || conv_id, '-') AS id,
           xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
               lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS fault
    FROM conversations, crc
), ids AS (
    SELECT id, any_value(conv_id) AS conv_id FROM hashed GROUP BY id
), rows_after AS (
    SELECT id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM hashed WHERE fault <> 0
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i FROM rows_after
), marked AS (
    SELECT *, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS blank,
           row_number() OVER (PARTITION BY id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') AS cut,
           substr(lag(role) OVER (PARTITION BY id ORDER BY i), 1, 1) || substr(role, 1, 1) NOT IN ('su', 'ua', 'au') AS illegal
    FROM numbered
), faults AS (
    SELECT *, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated, NOT blank AND NOT again AS stays FROM marked
), counted AS (
    SELECT id, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
           count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
    FROM faults GROUP BY id
), begun AS (
    SELECT id, 0 AS i, CAST({{'c': 0, 'a': '', 't': ''}} AS STRUCT(c BIGINT, a VARCHAR, t VARCHAR)) AS n,
           {nothing} AS s, {nothing} AS u, {nothing} AS a FROM counted
), paths AS (
    {inserted("begun")}
    UNION ALL
    SELECT id, i, n, s, {least("q.u", *[way(f"q.{x}", "2", "I", "'user:'") for x in ("n", "s", "a")])} AS u,
           {least("q.a", way("q.u", "2", "I", "'assistant:'"))} AS a
    FROM (
        SELECT r.id, CAST(r.i AS INTEGER) AS i, {after("n", "-", (), None, ())}, {after("s", "s", ("n",), None, ())},
               {after("u", "u", ("n", "s", "a"), "user", ("n", "s", "a"))}, {after("a", "a", ("u",), "assistant", ("u",))}
        FROM paths p JOIN faults r ON r.id = p.id AND r.i = p.i + 1
    ) q
), ended AS (
    SELECT c.id, {least("p.n", "p.a", way("p.u", "2", "I", "'assistant:'"))} AS best
    FROM counted c JOIN paths p ON p.id = c.id AND p.i = c.n_rows
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(best.t, '')) AS repaired_sha256
FROM ids LEFT JOIN counted USING (id) LEFT JOIN ended USING (id)
"""
