"""Personal data: plain forms, and identifiers that only their context gives away.

Plain forms are found by four patterns. They are the seeds of a bootstrap: the words around a seed make lexical
patterns, how it is spelled (its letters, digits and signs) makes another, and what else stands in such a place or is
spelled so is an instance. Instances are words of at least four characters with a digit or an ``@``, and runs of two or three
words with digits, which only their spelling can mark; what one of the four forms takes in full and then fails its
test (a card number that Luhn's sum rules out) is spelled like nothing.

Spark scores the graph of patterns and instances in rounds: a pattern is as good as the share of its
instances that are known, by being seeds or by other places where trusted patterns hold them; of that share
the lower end of its confidence interval counts, so that few instances prove little. Patterns that end with a high
score mark the instances they hold as identifiers of that kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellrecon.llm import memos
from cellrecon.llm.tables import chunks, id_and_text
from cellrecon.session import written

#: In the order in which spans that begin together are listed.
KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A digit run is tried from its first digit only: from a later one it ends the same way.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_MENTION = re.compile(r"\S*[0-9@]\S*")
_EDGES = " \t\n\r\x0b\x0c.,;:!?()[]{}<>\"'*#$%&|"

SPANS = "array<struct<kind:string,start:bigint,end:bigint>>"
_MENTIONS = "array<struct<start:bigint,end:bigint,instance:string,before:string,around:string,shape:string,seed:string>>"


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, looked for from each ``@``: a local part is the whole run before it, or what a match has left."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start and then kind."""
    found = [("email", a, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if _is_ip(m[0]):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if _is_card(m[0]):
                found.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if _is_phone(m[0]):
                    found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def _word(text: str) -> str:
    return text.strip(_EDGES).lower()


#: A longer word makes no pattern.
_LONGEST = 40


def _context(text: str, start: int, end: int) -> tuple[str | None, str | None]:
    """The patterns of a place: the two words before it, and the words on both sides. White space counts as one.

    A word of more than ``_LONGEST`` characters makes none.
    """
    reach = 3 * _LONGEST
    first = max(0, start - reach)
    left = text[first:start].split()
    if left and first and not text[first - 1].isspace() and not text[first].isspace():
        left[0] = ""  # only the end of a word
    right = text[end : end + reach].split()[:1]
    before = [_word(w) if len(w) <= _LONGEST else "" for w in left[-2:]]
    after = _word(right[0]) if right and len(right[0]) <= _LONGEST else ""
    if not before or not before[-1]:
        return None, None
    two = f"{before[0]} {before[1]} _" if len(before) == 2 and before[0] else None
    return two, f"{before[-1]} _ {after}" if after else None


_LETTER_RUN, _DIGIT_RUN, _SPACE_RUN = re.compile(r"[^\W\d_]+"), re.compile("[0-9]+"), re.compile(r"\s+")


def _shape(instance: str) -> str | None:
    """How something is spelled: a letter for each run of letters, a nine for a run of digits (with its length from five on)."""
    if len(instance) > 100:
        return None
    for form, test in ((_IP, _is_ip), (_CARD, _is_card), (_PHONE, _is_phone)):
        if form.fullmatch(instance) and not test(instance):
            return None
    plain = _LETTER_RUN.sub("a", _SPACE_RUN.sub(" ", instance))
    return "spelled " + _DIGIT_RUN.sub(lambda m: "9" if len(m[0]) < 5 else f"9{{{len(m[0])}}}", plain)


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 12 <= len(digits) <= 19 and _luhn(digits)


def _is_phone(text: str) -> bool:
    return 9 <= len(_DIGIT.findall(text)) <= 15


def mentions(text: str, known: list[tuple[str, int, int]]) -> list[dict]:
    """The known spans, and words with a digit or ``@`` or runs of words with digits that none of them touches, each with its patterns."""
    out = []
    for kind, start, end in known:
        out.append(_mention(text, start, end, kind))
    if "@" not in text and not _DIGIT.search(text):
        return out
    spans, k = sorted((a, b) for _, a, b in known), 0
    run: list[tuple[int, int]] = []  # the words with digits that follow each other directly, the last two
    for m in _MENTION.finditer(text):
        start, end = m.span()
        while start < end and text[start] in _EDGES:
            start += 1
        while end > start and text[end - 1] in _EDGES:
            end -= 1
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if any(a < m.end() and b > m.start() for a, b in spans[k : k + 8]):
            run = []
            continue
        if run and text[run[-1][1] : m.start()].strip():
            run = []
        if end - start >= 4:
            found = _mention(text, start, end, None)
            if found["before"] or found["around"] or found["shape"]:
                out.append(found)
        for first, _ in run:
            if 4 <= end - first <= 100:
                several = _mention(text, first, end, None)
                if several["shape"]:
                    out.append(several | {"before": None, "around": None})
        run = [*run, m.span()][-2:]
    return out


def _mention(text: str, start: int, end: int, seed: str | None) -> dict:
    before, around = _context(text, start, end)
    # A very long word is known by a digest, which only its equals share.
    instance = text[start:end] if end - start <= 100 else hashlib.sha256(text[start:end].encode()).hexdigest()
    shape = _shape(text[start:end])
    return {"start": start, "end": end, "instance": instance, "before": before, "around": around, "shape": shape, "seed": seed}


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(plain: DataFrame) -> DataFrame:
    """``id, key1, key2, base, base_sha256, mentions`` of every whole text; equal keys mean equal texts."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("pii")
        for batch in chunks(batches):
            base, digests, places = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                base.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                digests.append(hashlib.sha256(_listed(spans).encode()).hexdigest())
                places.append(mentions(text, spans))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("id", "key1", "key2")),
                    pa.array(base, _ARROW_SPANS),
                    pa.array(digests, pa.string()),
                    pa.array(places, _ARROW_MENTIONS),
                ],
                ["id", "key1", "key2", "base", "base_sha256", "mentions"],
            )

    kind = plain.schema["id"].dataType.simpleString()
    keyed = plain.select("id", "text", *_keys())
    return keyed.mapInArrow(
        find, f"id {kind}, key1 bigint, key2 bigint, base {SPANS}, base_sha256 string, mentions {_MENTIONS}"
    )


_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
_ARROW_MENTIONS = pa.list_(
    pa.struct([("start", pa.int64()), ("end", pa.int64()), *((c, pa.string()) for c in ("instance", "before", "around", "shape", "seed"))])
)


def _keys() -> list[Column]:
    return [F.xxhash64("text").alias("key1"), F.xxhash64(F.lit("second"), "text").alias("key2")]


def confident_patterns(
    scanned: DataFrame, rounds: int = 3, least_score: float = 0.7, confidence: float = 1.64
) -> DataFrame:
    """``pattern, kind`` of the patterns to trust. A spelling that only seeds have adds nothing and is left out.

    A pattern's score is the share of its instances that are known, less what so few of them leave open: the
    lower end of Wilson's interval, ``confidence`` standard deviations wide. So eight known ones of eight are
    just enough for a score of 0.7, and of a hundred three quarters must be known. Seeds keep their
    own kind throughout. Another instance is known by its witnesses, the different places where it stands: a place is
    as good as the best of its patterns, and only patterns that have the seeds and the score to be trusted
    count. For a pattern an instance is scored without the places of that pattern, so that none vouches for itself,
    nor two that hold the same places for each other; what is trusted rests on seeds alone, or on others trusted before.
    """
    places = scanned.select(F.explode("mentions").alias("m")).select("m.instance", "m.seed", "m.before", "m.around", "m.shape")
    # One row for each instance and pair of patterns: the same words around it again are the same witness.
    places = written(places.groupBy("instance", *_PATTERNS).agg(F.min("seed").alias("seed")), "pii-places")
    edges = written(
        _by_pattern(places).groupBy("pattern", "instance").agg(F.min("seed").alias("seed")), "pii-edges"
    )
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    # Without a seed a pattern can't be learned, so only these can ever be trusted.
    seeded = written(
        edges.filter("seed is not null")
        .groupBy("pattern", F.col("seed").alias("kind"))
        .agg(F.count(F.lit(1)).alias("seeds"))
        .join(totals, "pattern")
        .filter(~F.col("pattern").startswith("spelled ") | (F.col("n") > F.col("seeds"))),
        "pii-patterns",
    )
    unknown = places.filter("seed is null").drop("seed")
    trusted = None
    for _ in range(rounds + 1):
        scores = seeded.select("pattern", "kind", _bound(F.col("seeds"), F.col("n"), confidence).alias("score"))
        if trusted is not None:
            vouched = _vouched(unknown, trusted).groupBy("pattern", "kind").agg(F.sum("score").alias("sum"))
            scores = seeded.join(vouched, ["pattern", "kind"], "left").select(
                "pattern",
                "kind",
                _bound(F.least(F.col("seeds") + F.coalesce("sum", F.lit(0.0)), F.col("n")), F.col("n"), confidence).alias("score"),
            )
        trusted = written(scores.filter(F.col("score") >= least_score), "pii-trusted")
    return trusted.select("pattern", "kind")


_PATTERNS = ("before", "around", "shape")


def _bound(known: Column, n: Column, z: float) -> Column:
    """The lower end of Wilson's interval for ``known`` of ``n``."""
    share = known / n
    spread = F.sqrt(share * (1 - share) / n + z * z / (4 * n * n))
    return (share + z * z / (2 * n) - z * spread) / (1 + z * z / n)


def _by_pattern(places: DataFrame) -> DataFrame:
    """A row for each pattern of a place."""
    return places.withColumn("pattern", F.explode(F.array_compact(F.array(*_PATTERNS))))


def _vouched(places: DataFrame, trusted: DataFrame) -> DataFrame:
    """``pattern, instance, kind, score``: how well an instance is known by its places outside the pattern."""
    good = (
        _by_pattern(places)
        .join(trusted, "pattern")
        .groupBy("instance", *_PATTERNS, "kind")
        .agg(F.log(F.greatest(1 - F.max("score"), F.lit(1e-6))).alias("doubt"))
    )
    of_all = good.groupBy("instance", "kind").agg(F.sum("doubt").alias("all"), F.count(F.lit(1)).alias("n"))
    own = _by_pattern(good).groupBy("pattern", "instance", "kind").agg(F.sum("doubt").alias("own"), F.count(F.lit(1)).alias("n_own"))
    held = _by_pattern(places.join(of_all.select("instance").distinct(), "instance", "left_semi")).select("pattern", "instance").distinct()
    # Places are counted as well: where all are the pattern's own nothing is left, whatever the sums are rounded to.
    return (
        held.join(of_all, "instance")
        .join(own, ["pattern", "instance", "kind"], "left")
        .filter(F.col("n") > F.coalesce("n_own", F.lit(0)))
        .select("pattern", "instance", "kind", (1 - F.exp(F.col("all") - F.coalesce("own", F.lit(0.0)))).alias("score"))
    )


def discovered(scanned: DataFrame, patterns: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``more``: the spans that trusted patterns add, for the rows that have any."""
    free = scanned.select(*keys, F.explode("mentions").alias("m")).filter("m.seed is null").select(
        *keys, "m.start", "m.end", F.explode(F.array("m.before", "m.around", "m.shape")).alias("pattern")
    )
    hits = free.filter("pattern is not null").join(patterns, "pattern").groupBy(*keys, "start", "end").agg(F.min("kind").alias("kind"))
    return hits.groupBy(*keys).agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))


def _in_order(spans: Column) -> Column:
    rank = F.array(*map(F.lit, KINDS))
    ranked = F.transform(spans, lambda s: F.struct(s["start"].alias("a"), F.array_position(rank, s["kind"]).alias("b"), s["end"].alias("c"), s["kind"].alias("k")))
    text = F.transform(F.array_sort(ranked), lambda s: F.concat_ws(":", s["k"], s["a"].cast("string"), s["c"].cast("string")))
    return F.array_join(text, ",")


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **bootstrap) -> DataFrame:
    """A row for each document: its id, the numbers of plain forms ``n_email, n_ip, n_card, n_phone``, ``base_sha256`` of
    their list, ``spans`` with all spans listed and ``n_discovered``, how many of them patterns have added.

    A null or empty text has no spans. Null and repeated ids are kept, a row for each. An empty table
    gives no rows. Other columns are ignored. Places are code points, ends exclusive.
    """
    plain = id_and_text(docs, id_col, text_col)
    scanned = written(scan(plain).withColumn("row", F.monotonically_increasing_id()), "pii-scan")
    more = discovered(scanned, confident_patterns(scanned, **bootstrap), ["row"])
    spans = F.concat("base", F.coalesce("more", F.array().cast(SPANS)))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, lambda s: s == kind)).cast("bigint").alias(f"n_{kind}") for kind in KINDS]
    return scanned.drop("mentions").join(more, "row", "left").select(
        F.col("id").alias(id_col),
        *counts,
        "base_sha256",
        _in_order(spans).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("bigint").alias("n_discovered"),
    )


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Each span as its kind in brackets; of spans that overlap, the first and what goes on from it are one."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_documents(docs: DataFrame, text_col: str = "text", **bootstrap) -> DataFrame:
    """``docs`` with every span of the texts masked; a null text stays null, other columns stay as they are."""
    plain = docs.select(F.lit(None).cast("bigint").alias("id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    scanned = written(scan(plain), "pii-scan")
    patterns = confident_patterns(scanned, **bootstrap)
    distinct = scanned.filter("size(mentions) > size(base)").dropDuplicates(["key1", "key2"])
    more = written(discovered(distinct, patterns, ["key1", "key2"]), "pii-more")
    names = docs.columns
    inner = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)])
    t = f"c{names.index(text_col)}"
    keyed = inner.withColumn("key1", F.xxhash64(F.coalesce(t, F.lit("")))).withColumn(
        "key2", F.xxhash64(F.lit("second"), F.coalesce(t, F.lit("")))
    )
    joined = keyed.join(more, ["key1", "key2"], "left").drop("key1", "key2")
    columns = inner.columns

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos.start("pii")
        for batch in chunks(batches):
            made = []
            for text, added in zip(batch.column(t).to_pylist(), batch.column("more").to_pylist(), strict=True):
                if text is not None:
                    spans = base_spans(text) + [(s["kind"], s["start"], s["end"]) for s in added or []]
                    text = masked(text, spans) if spans else text
                made.append(text)
            kept = [pa.array(made, pa.string()) if c == t else batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(kept, columns)

    return joined.mapInArrow(mask, inner.schema).toDF(*names)
