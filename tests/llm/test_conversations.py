"""Structure repair and the prefix trie of conversations, against brute force over the same rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from bisect import bisect_right
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellrecon.llm import prefix_trie, queries, structure_repair
from cellrecon.llm.structure_repair import BLANK, CUT, DUPLICATE, FINE, lightest
from cellrecon.llm.tables import table
from tests.oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"

AWKWARD = [
    (1, 0, "user", "Hello."),
    (1, 0, "user", "Hello."),
    (1, None, "system", "Be kind."),
    (1, 3, "assistant", None),
    (1, 5, None, "odd role."),
    (2, 1, "assistant", "first"),
    (2, 2, "assistant", "second!"),
    (2, 2, "tool", " \t\n"),
    (3, None, None, None),
    (None, 0, "user", "nobody's?"),
    (None, 1, "assistant", "nobody's."),
    (4, 7, "user", "long " * 20_000 + "."),
    (4, 9, "assistant", "\xa0.\n"),
    (100, 0, "", ""),
    (100, 1, "user", "a\x0bb."),
    (104, 0, "user", "shared"),
    (104, 1, "assistant", "too"),
    (105, 0, "user", "shared"),
    (-3, 0, "user", "below zero?"),
]


def spelled(initials, faults):
    """Cheapest cost and least audit by trying all edit sequences."""
    n, best = len(initials), None

    def go(i, cost, audit, roles):
        nonlocal best
        if cost > 4 * n or (best is not None and cost > best[0]):
            return
        if i == n and re.fullmatch("(s?(ua)+)?", roles) and (best is None or (cost, audit) < best):
            best = (cost, audit)
        if i < n:
            go(i + 1, cost + 4, audit + "D", roles)
            if faults[i] not in (BLANK, DUPLICATE):
                cut = 3 if faults[i] == CUT else 0
                go(i + 1, cost + cut, audit + "K", roles + "sua?"[initials[i]])
                for x in "ua":
                    go(i + 1, cost + cut + 3, audit + "R", roles + x)
        for x in "ua":
            go(i, cost + 3, audit + "I", roles + x)

    go(0, 0, "", "")
    return best


def test_agenda_against_all_edit_sequences():
    chance = random.Random(5)
    for _ in range(300):
        n = chance.randint(0, 4)
        initials = bytes(chance.choice([0, 1, 1, 2, 2, 3]) for _ in range(n))
        faults = bytes(chance.choice([FINE, FINE, FINE, BLANK, DUPLICATE, CUT]) for _ in range(n))
        assert lightest(initials, faults) == spelled(initials, faults)


def by_positions(initials, faults):
    """The same by filling a table from the last row, with whole audits."""
    step = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (2, 2): 3, (3, 1): 2}

    def inserted(found):
        for _ in range(4):
            for (p, x), q in step.items():
                if x and q in found:
                    way = (found[q][0] + 3, "I" + found[q][1])
                    found[p] = min(found.get(p, way), way)
        return found

    after = inserted({0: (0, ""), 3: (0, "")})
    for x, fault in zip(reversed(initials), reversed(faults), strict=True):
        now = {q: (c + 4, "D" + a) for q, (c, a) in after.items()}
        if fault not in (BLANK, DUPLICATE):
            cut = 3 if fault == CUT else 0
            for (p, y), q in step.items():
                if q in after:
                    ways = [(after[q][0] + cut, "K" + after[q][1])] if y == x else []
                    ways += [(after[q][0] + cut + 3, "R" + after[q][1])] if y else []
                    for way in ways:
                        now[p] = min(now.get(p, way), way)
        after = inserted(now)
    return after[0]


def test_agenda_on_long_conversations():
    chance = random.Random(6)
    for n in (30, 100, 400):
        initials = bytes(chance.choice([0, 1, 1, 2, 2, 3]) for _ in range(n))
        faults = bytes(chance.choice([FINE, FINE, BLANK, DUPLICATE, CUT]) for _ in range(n))
        assert lightest(initials, faults) == by_positions(initials, faults)


def damaged_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        what = zlib.crc32(key.encode()) % 20
        if what == 1:
            text = ""
        if what == 2:
            text = re.sub("[.!?]", "", text)
        if what == 4:
            role = "user"
        out.append((conv, [] if what == 0 else [(turn, role, text)] * (2 if what == 3 else 1)))
    return out


def repaired(rows):
    """The contract's row for each conversation, in plain Python."""
    given = defaultdict(list)
    for conv, found in damaged_rows(rows):
        given[conv].extend(found)
    out = {}
    for conv, turns in given.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).digest()))
        numbers = {t[0] for t in turns} - {None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        faults, seen = [], set()
        for _, role, text in turns:
            bare = text.strip(SPACE)
            if not bare:
                faults.append(BLANK)
            elif (role, text) in seen:
                faults.append(DUPLICATE)
            else:
                faults.append(FINE if bare[-1] in ".!?" else CUT)
            seen.add((role, text))
        names = [t[1][:1] for t in turns]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(names, names[1:]))
        cost, audit = by_positions(bytes("sua".index(x) if x and x in "sua" else 3 for x in names), bytes(faults))
        done, at = [], 0
        for letter in audit:
            wanted = "assistant" if done and done[-1].startswith("u") else "user"
            if letter == "I":
                done.append(f"{wanted}:")
                continue
            _, role, text = turns[at]
            at += 1
            if letter != "D":
                done.append(f"{wanted if letter == 'R' else role}:{text}")
        counts = [faults.count(f) for f in (BLANK, DUPLICATE, CUT)]
        digest = hashlib.sha256("\n".join(done).encode()).hexdigest()
        out[conv] = (gaps, *counts, illegal, cost, audit, digest)
    return out


def test_repair_of_a_whole_table(spark):
    rows = [tuple(r) for r in table(spark, SF_DIR, "conversations").select("conv_id", "turn", "role", "text").collect()]
    found = {r[0]: tuple(r)[1:] for r in queries.op11_structure_repair(spark, SF_DIR).collect()}
    assert found == repaired(rows)


@pytest.mark.parametrize("partitions", [1, 5])
def test_repair_of_awkward_rows(spark, partitions):
    """Missing values, ties, repeated rows, long texts, clashing columns, all rows of a conversation dropped."""
    rows = AWKWARD + [(c, t, "user", f"{c} {t}.") for c in range(200, 400) for t in range(c % 3)]
    df = spark.createDataFrame(rows, TURNS).repartition(partitions)
    turns, there = structure_repair.damaged(df.withColumn("cost", F.lit(1)).withColumn("digest", F.lit("x")))
    found = structure_repair.repair_digests(turns, there).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == repaired(rows)
    assert len(found) == len({r[0] for r in rows})
    assert any(r["cost"] == 0 and r["audit"] == "" and r["repaired_sha256"] == hashlib.sha256().hexdigest() for r in found)


def test_repaired_turns_are_what_the_digest_is_of(spark):
    df = spark.createDataFrame(AWKWARD, TURNS)
    digests = {r["conv_id"]: r["repaired_sha256"] for r in structure_repair.repair_digests(df).collect()}
    turns = defaultdict(list)
    for r in structure_repair.repaired_turns(df).orderBy("place").collect():
        turns[r["conv_id"]].append(r)
    for conv, digest in digests.items():
        assert [r["place"] for r in turns[conv]] == list(range(len(turns[conv])))
        assert hashlib.sha256("\n".join(f"{r['role']}:{r['text']}" for r in turns[conv]).encode()).hexdigest() == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(r["role"][:1] for r in turns[conv]))


def test_no_conversations(spark):
    none = spark.createDataFrame([], TURNS)
    assert structure_repair.repair_digests(none).count() == 0
    assert structure_repair.repaired_turns(none).count() == 0
    assert prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths(none))).count() == 0


def nodes(rows):
    """The trie by grouping all prefixes, in plain Python."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, tie, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        whole[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in whole.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    below = defaultdict(list)
    for n in members:
        if n:
            below[n[:-1]].append(n)
    leaves, saved = defaultdict(int), defaultdict(int)
    for n, m in members.items():
        for d in range(len(n) + 1):
            leaves[n[:d]] += not below[n]
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
    return sorted(
        (
            min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(below[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n, m in members.items()
    )


def found_nodes(df):
    return sorted(tuple(-1 if v is None else v for v in r) for r in df.select(prefix_trie.COLUMNS).collect())


def test_trie_of_a_whole_table(spark):
    problem = compare(queries.op12_prefix_trie(spark, SF_DIR), connect(SF_DIR), queries.OP12_SQL)[1]
    assert problem is None


def crowded():
    """One conversation many times, a first turn that most share, deep paths with common beginnings."""
    chance = random.Random(8)
    rows = list(AWKWARD)
    for c in range(1000, 2200):
        kind = c % 3
        if kind == 0:
            rows += [(c, t, "user", f"same {t}") for t in range(4)]
        elif kind == 1:
            rows += [(c, 0, "user", "hello")] + [(c, 1 + t, "assistant", str(chance.randint(0, 3))) for t in range(3)]
        else:
            depth = chance.randint(1, 40)
            rows += [(c, t, "user", f"deep {t}") for t in range(depth)] + [(c, depth, "user", str(chance.randint(0, 2)))]
    return rows


@pytest.mark.parametrize("shards", [1, 8, 200])
def test_trie_of_awkward_rows(spark, shards):
    """Any number of shards gives the same nodes, also with hot paths, hot first turns and turnless conversations."""
    rows = crowded()
    df = spark.createDataFrame(rows, TURNS).withColumn("path", F.lit("x")).withColumn("base", F.lit(1))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = found_nodes(prefix_trie.prefix_trie(prefix_trie.rebuilt(prefix_trie.paths(df))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found == nodes(rows)


def test_separators_cover_nodes_on_both_sides():
    chance = random.Random(9)
    entry = [bytes([k]) * prefix_trie.ENTRY for k in range(3)]
    paths = sorted({b"".join(chance.choices(entry, k=chance.randint(0, 9))) for _ in range(3000)})

    cuts = []
    for k in range(1, 60):
        a, b = paths[k * len(paths) // 60 - 1], paths[k * len(paths) // 60]
        same = 0
        while a[same : same + 24] == b[same : same + 24]:
            same += 24
        cuts.append(b[: same + 24])
    inner = set(prefix_trie._Skeleton(cuts).children.values()) | {0}
    shape = prefix_trie._Skeleton(cuts)
    assert len(shape.rows) == len(inner)
    names = {p for c in cuts for p in (c[:k] for k in range(0, len(c), 24))}
    where = defaultdict(set)
    for p in paths:
        for k in range(0, len(p) + 1, 24):
            where[p[:k]].add(bisect_right(cuts, p))
    assert {p for p, shards in where.items() if len(shards) > 1} <= names
