"""Repair of conversations as the lightest derivation of a small weighted deduction system.

A repaired conversation has role initials ``(s?(ua)+)?``: nothing, or an optional system turn and pairs
of user and assistant. Its states are 0 (start), 1 (after the system turn), 2 (after a user turn) and 3
(after an assistant turn). The item ``(m, q)`` says that the last ``m`` rows can be edited into what
state ``q`` still needs; its weight is the cheapest cost and, of the cheapest, the ASCII-least audit:

    axioms   (0, 0) and (0, 3), where the start and a finished pair need nothing more
    Delete   (m, q)                          ->  (m + 1, q)    cost 4
    Keep     (m, q), row m + 1 leads p to q  ->  (m + 1, p)    cost 0, 3 if the row is truncated
    Rerole   (m, q), u or a leads p to q     ->  (m + 1, p)    cost 3, 3 more if it is truncated
    Insert   (m, q), u or a leads p to q     ->  (m, p)        cost 3

Edits are put in front, so an audit that is less stays less (the functions are monotone), and every
edit makes (cost, rows taken) greater (they are superior). Items are therefore final when they leave
an agenda ordered by cost, rows taken and first letter, as Knuth showed for such grammars, and the agenda
stops at the goal ``(n, 0)``. Two edits with the same letter never lead to one item, so the first letter
alone settles ties and back pointers of one letter an item spell the whole audit.

Rows of a conversation stream through one task in order. Of a row the agenda sees its initial and its
fault (two bytes, and a digest to know repeated rows by); texts move once, to be written out or hashed
behind the finished audit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrecon.llm.tables import chunks

#: Letters in ASCII order; a letter's place is its rank in ties.
DELETE, INSERT, KEEP, REROLE = range(4)
LETTERS = "DIKR"
_COST = {DELETE: 4, INSERT: 3, KEEP: 0, REROLE: 3}
_TRUNCATED = 3
# Role initials as small numbers; anything else is `_OTHER`, which no state takes.
_S, _U, _A, _OTHER = range(4)
_NEXT = {(0, _S): 1, (0, _U): 2, (1, _U): 2, (2, _A): 3, (3, _U): 2}
_BEFORE = [[tuple(p for (p, x), q2 in _NEXT.items() if q2 == q and x == y) for y in range(4)] for q in range(4)]
#: What a state takes when the letter leaves the choice of a role to it: user, but assistant after user.
_TAKES = (_U, _U, _A, _U)
_LEGAL = {(_S, _U), (_U, _A), (_A, _U)}

FINE, BLANK, DUPLICATE, CUT = range(4)
_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

AUDITS = (
    "conv_id {id}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"
)


def lightest(initials: bytes, faults: bytes) -> tuple[int, str]:
    """Cost and audit of the lightest derivation for rows with these initials and faults."""
    n = len(initials)
    width = n + 1
    # A deduction is one number: cost, rows taken, letter, state. Numbers compare like these tuples.
    agenda = [3, 0]
    heapify(agenda)
    letters = bytearray(b"\xff" * (4 * width))
    axiom = 0xFE
    while True:
        taken = heappop(agenda)
        state, rest = taken & 3, taken >> 4
        cost, m = divmod(rest, width)
        item = 4 * m + state
        if letters[item] != 0xFF:
            continue
        letters[item] = axiom if m == 0 and cost == 0 else (taken >> 2) & 3
        if m == n and state == 0:
            break
        for x in (_U, _A):
            for before in _BEFORE[state][x]:
                if letters[4 * m + before] == 0xFF:
                    heappush(agenda, (((cost + 3) * width + m) << 4) | (INSERT << 2) | before)
        if m == n:
            continue
        row, above = n - 1 - m, m + 1
        fault, own = faults[row], initials[row]
        heappush(agenda, (((cost + 4) * width + above) << 4) | (DELETE << 2) | state)
        if fault == BLANK or fault == DUPLICATE:
            continue
        kept = cost + _TRUNCATED if fault == CUT else cost
        for before in _BEFORE[state][own]:
            heappush(agenda, ((kept * width + above) << 4) | (KEEP << 2) | before)
        for x in (_U, _A):
            for before in _BEFORE[state][x]:
                heappush(agenda, (((kept + 3) * width + above) << 4) | (REROLE << 2) | before)
    return cost, _spell(letters, initials)


def _spell(letters: bytearray, initials: bytes) -> str:
    n = len(initials)
    m, state, audit = n, 0, []
    while (letter := letters[4 * m + state]) != 0xFE:
        audit.append(LETTERS[letter])
        if letter in (INSERT, REROLE):
            state = _NEXT[state, _TAKES[state]]
        elif letter == KEEP:
            state = _NEXT[state, initials[n - m]]
        if letter != INSERT:
            m -= 1
    return "".join(audit)


def _plain(turns: DataFrame, present: Column | None) -> DataFrame:
    """Rows with the features that edits depend on, under names of their own."""
    role, text = F.coalesce(turns["role"], F.lit(" ")), F.coalesce(turns["text"], F.lit(" "))
    rows = turns.select(
        turns["conv_id"].alias("conv_id"),
        turns["turn"].alias("turn"),
        role.alias("role"),
        text.alias("text"),
        (F.lit(True) if present is None else present).alias("there"),
    )
    end = F.rtrim("text", F.lit(_SPACE))
    first = F.substring("role", 1, 1)
    return rows.select(
        "*",
        F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest"),
        F.when(first == "s", _S).when(first == "u", _U).when(first == "a", _A).otherwise(_OTHER).alias("initial"),
        F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), FINE).otherwise(CUT).alias("fault"),
    )


# Rows of a conversation in order: by turn, missing ones first, then by digest, so that ties have an order too.
_ORDER = ("conv_id", "turn", "digest")


def audits(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """A row for each conversation: gaps, faults, illegal neighbours, cost and audit of its lightest repair.

    ``turns`` has ``conv_id, turn, role, text``; other columns are ignored. Where ``present`` is given, rows for which it is
    false are no turns and only make their conversation appear, with zeros and an empty audit if it has no other. A missing
    role or text counts as one space, a missing turn comes first, rows without ``conv_id`` are one conversation. Rows of
    one turn are ordered by a digest of role and text; repeated rows are duplicates. No rows give no rows.
    """
    return _audits(_plain(turns, present))


def _audits(rows: DataFrame) -> DataFrame:
    skinny = rows.select(*_ORDER, "initial", "fault", "there").repartition("conv_id").sortWithinPartitions(*_ORDER)
    schema = AUDITS.format(id=skinny.schema["conv_id"].dataType.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]
    id_type = pa.int64() if " bigint," in schema.split("gaps")[0] else None

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        open_id, conv = None, None

        def finish():
            if conv is not None:
                done.append((open_id, *conv.result()))

        def flush():
            columns = list(zip(*done)) if done else [[] for _ in names]
            types = [id_type] + [pa.int64()] * 6 + [pa.string()]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)
            done.clear()
            return out

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in (*_ORDER, "initial", "fault", "there")), strict=True):
                if conv is None or row[0] != open_id:
                    finish()
                    open_id, conv = row[0], _Conversation()
                if row[5]:
                    conv.add(*row[1:5])
            if len(done) >= 1024:
                yield flush()
        finish()
        if done:
            yield flush()

    return skinny.mapInArrow(judge, schema)


class _Conversation:
    """What must be known of one conversation while its rows pass."""

    def __init__(self):
        self.initials, self.faults, self.seen = bytearray(), bytearray(), set()
        self.first = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn, digest: bytes, initial: int, fault: int) -> None:
        if turn is not None and turn != self.last:
            self.turns += 1
            self.last = turn
            if self.first is None:
                self.first = turn
        if self.initials and (self.initials[-1], initial) not in _LEGAL:
            self.illegal += 1
        if fault != BLANK:
            if digest in self.seen:
                fault = DUPLICATE
            self.seen.add(digest)
        self.initials.append(initial)
        self.faults.append(fault)

    def result(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        counts = [self.faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        cost, audit = lightest(bytes(self.initials), bytes(self.faults))
        return (gaps, *counts, self.illegal, cost, audit)


def repaired_turns(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """The repaired conversations themselves: ``conv_id, place, edit, role, text``, inserted turns with an empty text.

    Rows and missing values are taken as by :func:`audits`. Conversations whose every turn is deleted have no rows.
    """
    rows = _plain(turns, present)
    schema = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, place bigint, edit string, role string, text string"
    names = [f.split()[0] for f in schema.split(", ")]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for head, place, edit, role, text in _walk(batches):
            if place is not None:
                out.append((head["conv_id"], place, edit, role, text))
                size += len(text)
                if len(out) >= 4096 or size > 1 << 24:
                    yield _batch(out, names)
                    out, size = [], 0
        if out:
            yield _batch(out, names)

    def _batch(rows_, names_):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows_)], names_)

    return _beside_texts(rows).mapInArrow(write, schema)


def repair_digests(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """:func:`audits` with ``repaired_sha256``, of the repaired ``role:text`` joined by line ends (none: of the empty text)."""
    rows = _plain(turns, present)
    joined = _beside_texts(rows)
    schema = AUDITS.format(id=rows.schema["conv_id"].dataType.simpleString()) + ", repaired_sha256 string"
    names = [f.split()[0] for f in schema.split(", ")]
    id_type = pa.int64() if schema.startswith("conv_id bigint") else None
    types = [id_type] + [pa.int64()] * 6 + [pa.string()] * 2

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, running = [], None
        for head, place, _, role, text in _walk(batches):
            if place is None:
                out.append((*(head[c] for c in names[:-1]), running.hexdigest() if running else hashlib.sha256().hexdigest()))
                running = None
                if len(out) >= 1024:
                    yield _batch(out)
                    out = []
                continue
            if running is None:
                running = hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:".encode())
            running.update(text.encode())
        if out:
            yield _batch(out)

    def _batch(rows_):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows_), types, strict=True)], names)

    return joined.mapInArrow(digest, schema)


def _beside_texts(rows: DataFrame) -> DataFrame:
    """Each conversation's audit followed by its rows in order, within one partition."""
    found = _audits(rows)
    given = rows.where("there").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "digest", "role", "text", "initial",
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields[1:]],
    )
    heads = found.select(
        "conv_id", F.lit(0).alias("kind"),
        *[F.lit(None).cast(given.schema[c].dataType).alias(c) for c in ("turn", "digest", "role", "text", "initial")],
        *found.columns[1:],
    )
    both = heads.unionByName(given)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "digest")


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Repaired turns as ``(head, place, edit, role, text)``, and ``(head, None, ...)`` behind each conversation's last."""
    head, at, place, state = None, 0, 0, 0
    roles = {_U: "user", _A: "assistant"}

    def inserted():
        nonlocal at, place, state
        audit = head["audit"]
        while at < len(audit) and audit[at] == "I":
            role, state = roles[_TAKES[state]], _NEXT[state, _TAKES[state]]
            at += 1
            place += 1
            yield head, place - 1, "I", role, ""

    for batch in batches:
        for piece in chunks([batch], 256):
            for row in piece.to_pylist():
                if row["kind"] == 0:
                    if head is not None:
                        yield from inserted()
                        yield head, None, None, None, None
                    head, at, place, state = row, 0, 0, 0
                    continue
                yield from inserted()
                edit, role = head["audit"][at], row["role"]
                at += 1
                if edit == "D":
                    continue
                if edit == "R":
                    role, state = roles[_TAKES[state]], _NEXT[state, _TAKES[state]]
                else:
                    state = _NEXT[state, row["initial"]]
                place += 1
                yield head, place - 1, edit, role, row["text"]
    if head is not None:
        yield from inserted()
        yield head, None, None, None, None


def damaged(conversations: DataFrame) -> tuple[DataFrame, Column]:
    """Conversations with faults planted by a hash of conversation and turn, and the column that says which rows are there.

    Of ``crc32('conv_id:turn') % 20``: 0 drops the row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it and 4
    makes its role user. Missing values count as one space, in the hash too.
    """
    named = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    what = F.crc32(F.concat(named["conv_id"], F.lit(":"), named["turn"]).cast("binary")) % 20
    hit = conversations.select("conv_id", "turn", named["role"].alias("role"), named["text"].alias("text"), what.alias("what"))
    rows = hit.select(
        "conv_id",
        "turn",
        F.when(F.col("what") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("what") == 1, "")
        .when(F.col("what") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("what") != 0).alias("there"),
        F.explode(F.when(F.col("what") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")
    return rows, F.col("there")
