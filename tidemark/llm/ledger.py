"""Secret scans through an incremental ledger of content-addressed texts.

Every version of every path is named by the SHA-256 of its text (the blob). ``Ledger.record`` writes
the versions of one wave (path columns and digest, no text), works out which pairs of blob and rule
version no earlier wave has scanned, scans just those, and commits the wave by one log entry; a wave
that dies before that entry does not exist. Findings belong to blobs; ``Ledger.findings`` joins them
back to all paths of all versions. A rule with a new version, or a new rule, is unseen for every
blob, so recording the same versions again scans them with that rule alone.

Only texts that hold an unseen pair move: digests are compared first, on narrow rows. Each task
sends a text once, compressed; if few blobs are unseen (at most ``FEW``) their digests are broadcast
and all other texts stay where they are, otherwise they are sorted out where their digests meet.
Copies have been dropped by then, so a text that makes up a third of all rows costs one row a task.
On the way back paths of one digest are spread over ``SALTS`` groups, and findings follow them only
into groups that exist.

Defined cases: a NULL text is empty; rows with NULL ids and repeated rows are paths like others and
each gets the findings of its text; texts are scanned whole; an empty table gives an empty wave.
Other columns than the path columns asked for are left out. Findings are ordered by start, then by
the rules' order.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.arrow import named, slices
from tidemark.llm.graph import stored
from tidemark.sources import commits

FEW = 200_000  # digests of 32 bytes: some 20 MB when broadcast
SALTS = 256
LEVEL = 3  # of the compression of moving texts


@dataclass(frozen=True)
class Rule:
    """A pattern; the version goes up whenever pattern or limits change.

    A match counts if its group has ``least`` characters; a match that fails is passed over whole.
    ``hints`` are lower-case strings of which the lower-cased text must hold one.
    """

    name: str
    version: int
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False
    hints: tuple[str, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.name}@{self.version}"


# The base rules. Runs of AKIA... and of hex digits are matched whole either way, so
# their least length stands in the pattern.
BASE = (
    Rule(
        "assign", 1, r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""", 6, 2, True, ("passw", "secret", "token", "api"),
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}", hints=("akia",)),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
)
# Rules beyond the base: private key blocks, signed web tokens, credentials inside addresses. The
# look-behinds let a long run be entered only at its start, so no text takes quadratic time.
ADDED = (
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----", hints=("private key",)),
    Rule(
        "jwt", 1, r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        hints=("eyj",),
    ),
    Rule(
        "login", 1, r"(?<![A-Za-z0-9+.-])[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@", hints=("://",)
    ),
)
RULES = BASE + ADDED


def scan(text: str, rules: Sequence[Rule]) -> list[tuple[str, int, int]]:
    """(rule name, start, end) in code points, per rule leftmost and non-overlapping."""
    found = []
    low = None
    for rule in rules:
        if rule.hints:
            if low is None:
                low = text.lower()
            if not any(h in low for h in rule.hints):
                continue
        flags = re.ASCII | (re.IGNORECASE if rule.any_case else 0)
        for m in re.compile(rule.pattern, flags).finditer(text):
            if m.end(rule.group) - m.start(rule.group) >= rule.least:
                found.append((rule.name, m.start(), m.end()))
    return found


_FOUND = "array<struct<rule:string,start:long,end:long>>"
_SPAN = pa.struct([("rule", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _digest(text: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(named(text), F.lit("")), 256))


def _senders(batches: Iterable[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    """One compressed copy of each text of a task: digest, rules (a bitmask) and text."""
    import zstandard

    packer = zstandard.ZstdCompressor(level=LEVEL)
    sent: set[bytes] = set()
    for batch in slices(batches):
        digests, masks = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out = []
        for i, digest in enumerate(digests):
            if digest not in sent:
                sent.add(digest)
                text = (batch.column(2)[i].as_py() or "").encode("utf-8", "surrogatepass")
                out.append((digest, masks[i], packer.compress(text)))
        if out:
            yield pa.RecordBatch.from_arrays([
                pa.array(c, t) for c, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.binary()))
            ], names=["digest", "mask", "packed"])


def _scanner(rules: tuple[Rule, ...]):
    """Each digest of a partition once: digest, the keys of the rules applied, and what they found."""
    def run(batches):
        import zstandard

        opener = zstandard.ZstdDecompressor()
        done: set[bytes] = set()
        for batch in slices(batches, 64):
            out = []
            for digest, mask, packed in zip(*[c.to_pylist() for c in batch.columns]):
                if digest in done:
                    continue
                done.add(digest)
                asked = [r for i, r in enumerate(rules) if mask >> i & 1]
                text = opener.decompress(packed).decode("utf-8", "surrogatepass")
                spans = [dict(zip(("rule", "start", "end"), f)) for f in scan(text, asked)]
                out.append((digest, [r.key for r in asked], spans))
            if out:
                types = (pa.binary(), pa.list_(pa.string()), pa.list_(_SPAN))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), types)],
                    names=["digest", "rules", "found"],
                )

    return run


@dataclass
class Ledger:
    """The waves under ``folder``, which all machines share."""

    spark: SparkSession
    folder: str
    rules: tuple[Rule, ...] = field(default=RULES)

    def __post_init__(self):
        if not 0 < len(self.rules) <= 62 or len({r.name for r in self.rules}) < len(self.rules):
            raise ValueError("between 1 and 62 rules, each name once")

    def waves(self) -> list[dict]:
        return [e for _, e in commits.entries(self.spark, f"{self.folder}/_log")]

    def _table(self, kind: str) -> DataFrame | None:
        frames = [self.spark.read.parquet(f"{w['folder']}/{kind}") for w in self.waves()]
        return reduce(DataFrame.unionByName, frames) if frames else None

    def record(self, versions: DataFrame, keep: list[str], text: str = "text") -> dict:
        """Add one wave: the paths (columns ``keep``) and texts of ``versions``. Returns its entry."""
        folder = f"{self.folder}/wave-{uuid.uuid4().hex}"
        names = [f"k{i}" for i in range(len(keep))]
        # The groups are written, so every later reading sees the same ones.
        versions.select(
            *[named(c).alias(n) for c, n in zip(keep, names)], _digest(text).alias("digest"),
            (F.monotonically_increasing_id() % SALTS).cast("int").alias("salt"),
        ).write.parquet(f"{folder}/paths")
        paths = self.spark.read.parquet(f"{folder}/paths")
        source = versions.select(_digest(text).alias("digest"), named(text).alias("text"))
        everything = F.lit((1 << len(self.rules)) - 1).cast("long")
        seen = self._table("scans")
        if seen is None:
            moved = source.select("digest", everything.alias("mask"), "text").mapInArrow(
                _senders, "digest binary, mask long, packed binary"
            ).repartition("digest")
        else:
            unseen = stored(self._unseen(paths, seen), "unseen")
            few = unseen.count() <= FEW
            near = source.join(F.broadcast(unseen), "digest") if few else source.withColumn(
                "mask", everything
            )
            moved = near.select("digest", "mask", "text").mapInArrow(
                _senders, "digest binary, mask long, packed binary"
            ).repartition("digest")
            if not few:
                moved = moved.drop("mask").join(unseen, "digest").select("digest", "mask", "packed")
        moved.mapInArrow(
            _scanner(self.rules), f"digest binary, rules array<string>, found {_FOUND}"
        ).write.parquet(f"{folder}/scans")
        entry = {"folder": folder, "keep": keep, "rules": [r.key for r in self.rules]}
        number = len(self.waves()) + 1
        while not commits.append(self.spark, f"{self.folder}/_log", number, entry):
            number += 1  # another writer: waves do not depend on each other's order
        return entry

    def _unseen(self, paths: DataFrame, seen: DataFrame) -> DataFrame:
        """(digest, mask) of this wave's blobs and the rules that have not seen them."""
        known = seen.select("digest", F.explode("rules").alias("rule")).distinct()
        bits = reduce(
            lambda otherwise, pair: F.when(F.col("rule") == pair[1].key, 1 << pair[0]).otherwise(otherwise),
            enumerate(self.rules), F.lit(0),
        ).cast("long")
        scanned = known.groupBy("digest").agg(F.sum(bits).alias("scanned"))
        mask = F.lit((1 << len(self.rules)) - 1).cast("long") - F.coalesce("scanned", F.lit(0))
        return paths.select("digest").distinct().join(scanned, "digest", "left").select(
            "digest", mask.alias("mask")
        ).where("mask > 0")

    def blobs(self) -> DataFrame | None:
        """digest and ``found`` of all blobs in which the ledger's rules found anything."""
        scans = self._table("scans")
        if scans is None:
            return None
        names = F.array(*[F.lit(r.name) for r in self.rules])
        keys = F.array(*[F.lit(r.key) for r in self.rules])
        # Only findings of the rule versions in force: an earlier version of a rule found its own.
        in_force = F.transform(F.array_intersect("rules", keys), lambda k: F.split_part(k, F.lit("@"), F.lit(1)))
        hits = scans.where(F.size("found") > 0).withColumn("names", in_force).withColumn(
            "found", F.filter("found", lambda f: F.array_contains("names", f["rule"]))
        )
        if len(self.waves()) > 1:  # several waves may have scanned a blob, with other rules each
            hits = hits.groupBy("digest").agg(F.flatten(F.collect_list("found")).alias("found"))
        ordered = F.transform(F.array_distinct("found"), lambda f: F.struct(
            f["start"].alias("start"), F.array_position(names, f["rule"]).alias("place"),
            f["end"].alias("end"), f["rule"].alias("rule"),
        ))
        return hits.select("digest", F.sort_array(ordered).alias("found")).where(F.size("found") > 0)

    def findings(self, digest: Sequence[Column] = ()) -> DataFrame | None:
        """Per recorded path: its columns, digest, ``found`` (NULL without findings) and ``digest``.

        ``digest`` columns are computed once per blob, from ``found``; they are NULL without findings.
        """
        blobs, waves = self.blobs(), self.waves()
        if blobs is None:
            return None
        paths = self._table("paths")
        extra = [c.alias(f"x{i}") for i, c in enumerate(digest)]
        about = stored(blobs.select("digest", "found", *extra), "blobs")
        groups = paths.select("digest", "salt").distinct().join(about, "digest")
        kept = waves[0]["keep"]
        return paths.join(groups, ["digest", "salt"], "left").select(
            *[F.col(f"k{i}").alias(c) for i, c in enumerate(kept)], "digest", "found",
            *[f"x{i}" for i in range(len(extra))],
        )


def _spans(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda f: F.concat_ws(
        ":", f["rule"], f["start"].cast("string"), f["end"].cast("string")
    )), ",")


def report(docs: DataFrame, folder: str, by: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: counts of the base rules, digest of their spans, and all spans."""
    ledger = Ledger(docs.sparkSession, folder)
    ledger.record(docs, [by], text)
    base = F.filter("found", lambda f: f["rule"].isin([r.name for r in BASE]))

    def counted(name: str) -> Column:
        return F.size(F.filter("found", lambda f: f["rule"] == name)).cast("long")

    counts = [counted(r.name) for r in BASE]
    rows = ledger.findings([*counts, F.sha2(_spans(base), 256), _spans(F.col("found"))])
    nothing = F.sha2(F.lit(""), 256)
    return rows.select(
        named(by).alias("doc_id"),
        *[F.coalesce(f"x{i}", F.lit(0)).alias(f"n_{r.name}") for i, r in enumerate(BASE)],
        F.coalesce("x3", nothing).alias("base_sha256"), F.coalesce("x4", F.lit("")).alias("spans"),
    )
