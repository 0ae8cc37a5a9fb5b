"""Personal data: fixed patterns, and identifiers that their contexts give away.

Built-in column functions only. The fixed patterns (email, ip, card, phone) give the base spans;
``regexp_extract_all`` has the matches, ``split`` the text between them, and their lengths the
offsets. The patterns are written so that no text makes them backtrack: a run is entered at its
first character or where the last match ended, and repeats are possessive. Offsets are running sums
over a text's matches; they are built in pieces of the root of their number, as is the masked text,
so a text of very many matches costs little more than one of few.

Bootstrapping starts from the base matches. An *instance* is a word that looks like an identifier
(an @ or five digits) or a base span written with blanks, a *pattern* the word before it. A pattern's confidence is the score of its
instances over their number, for its best kind; an instance's score joins the confidences of its
patterns (one minus the product of their doubts). Seeds have score 1. Patterns need ``SUPPORT``
seeds and ``CONFIDENT`` confidence, new instances two different patterns and ``ACCEPTED``, or one of
``SOLE_SUPPORT`` and ``SOLE_CONFIDENT``, and count as seeds do in the next round, until none is new.
All occurrences of accepted instances become spans of their kind, unless they touch a base span. Words
and identifiers may have any length.

Defined cases: NULL texts are empty; repeated rows give equal results and NULL ids are kept; texts are
searched whole; offsets are characters (code points), ends exclusive; of kinds with equal scores the
first named counts; extra columns are left out of the report and kept by ``redact``; an empty table
gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.arrow import free_name, named
from tidemark.llm.graph import stored

KINDS = ("email", "ip", "card", "phone")
SUPPORT = 5
CONFIDENT = 0.8
SOLE_SUPPORT = 100
SOLE_CONFIDENT = 0.95
ACCEPTED = 0.9

_LOCAL = "A-Za-z0-9._%+-"
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
_PATTERNS = (
    rf"(?:(?<![{_LOCAL}])|\G)[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[ -]?[0-9])++",
    r"\+[0-9][ ().0-9-]+[0-9]",
)
# What a text must hold to be searched for the kind at all.
_HINTS = (
    "@", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", r"[0-9](?:[ -]?[0-9]){15}", r"\+[0-9]",
)
_SPAN = "struct<kind:int,start:int,stop:int,value:string>"
_MATCH = "struct<kind:int,start:int,stop:int,value:string,gap:string>"
# An identifier-like word after another word. Every repeat is possessive, so words of any length pass.
_WORD = r"[^\s@]*+@\S++|(?:[^\s0-9]{0,3}[0-9]){5,}+[^\s0-9]{0,8}"
_CONTEXT = rf"(?<!\S)(\S++)\s++(?=({_WORD})(?!\S))"
_LAST_WORD = r"(?<!\S)(\S++)\s*+$"
_CONTEXT_HINT = r"@|[0-9](?:[^\s0-9]{0,3}[0-9]){4}"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: int, value: Column) -> Column:
    if kind == 1:
        return value.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == 2:
        return F.length(_digits(value)).between(16, 19) & F.call_function("luhn_check", _digits(value))
    if kind == 3:
        return F.length(_digits(value)).between(8, 15)
    return F.lit(True)


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _chunks(items: Column) -> Column:
    """The array, a bound one, cut into arrays of about the root of its size."""
    size = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(items))).cast("int"))
    count = F.ceil(F.size(items) / size).cast("int")
    return F.transform(
        F.sequence(F.lit(1), F.greatest(count, F.lit(1))), lambda i: F.slice(items, (i - 1) * size + 1, size)
    )


def _total(lengths: Column) -> Column:
    return F.aggregate(lengths, F.lit(0), lambda s, n: s + n)


def _placed(text: Column, pattern: str, kind: int, group: int = 0, after: bool = False) -> Column:
    """All matches as spans, with the text between each and the one before it.

    With ``after``, the spans are those of ``group`` right behind each match.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    parts = F.filter(
        F.arrays_zip(whole.alias("m"), value.alias("v"), F.split(text, pattern, -1).alias("gap")),
        lambda x: x["m"].isNotNull(),
    )

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        start = end if after else begin
        span = F.struct(
            F.lit(kind).alias("kind"), start.alias("start"),
            (start + F.length(x["v"])).alias("stop"), x["v"].alias("value"), x["gap"].alias("gap"),
        )
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    none = F.array().cast(f"array<{_MATCH}>")

    def length(piece: Column) -> Column:
        return F.aggregate(piece, F.lit(0), lambda s, x: s + F.length(x["gap"]) + F.length(x["m"]))

    def spans(pieces: Column) -> Column:
        """Each piece starts where the ones before it end."""
        return _let(F.transform(pieces, length), lambda lengths: F.flatten(
            F.transform(pieces, lambda piece, i: F.aggregate(
                piece, F.struct(_total(F.slice(lengths, 1, i)).alias("at"), none.alias("out")),
                step, lambda acc: acc["out"],
            ))
        ))

    return _let(parts, lambda bound: _let(_chunks(bound), spans))


def _kind_matches(text: Column, kind: int) -> Column:
    none = F.array().cast(f"array<{_MATCH}>")
    hint = text.contains("@") if kind == 0 else text.rlike(_HINTS[kind])
    spans = F.when(hint, _placed(text, _PATTERNS[kind], kind)).otherwise(none)
    return F.filter(spans, lambda s: _valid(kind, s["value"]))


def _kind_spans(text: Column, kind: int) -> Column:
    return F.transform(_kind_matches(text, kind), lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"),
        s["value"].alias("value"),
    ))


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, stop, value>> by kind, then start."""
    return F.concat(*[_kind_spans(text, k) for k in range(len(KINDS))])


def _clean(word: Column) -> Column:
    return F.regexp_replace(F.lower(word), r"[^\p{L}:#=]", "")


def contexts(docs: DataFrame) -> DataFrame:
    """Occurrences of identifier-like words, and of base spans that hold blanks.

    id, hash, word, its place and the word before it.

    ``docs`` has id, hash and text.
    """
    text = F.col("text")
    likely = docs.where(text.rlike(_CONTEXT_HINT))
    spans = _placed(text, _CONTEXT, 0, 2, after=True)
    lefts = F.regexp_extract_all(text, F.lit(_CONTEXT), F.lit(1))
    rows = likely.select("id", "hash", F.inline(F.zip_with(spans, lefts, lambda s, x: F.struct(
        s["value"].alias("word"), s["start"].alias("start"), s["stop"].alias("stop"),
        _clean(x).alias("pattern"),
    ))))
    # Cards and phones with blanks: the word before them ends the gap that they follow.
    spaced = F.filter(
        F.concat(_kind_matches(text, 2), _kind_matches(text, 3)), lambda s: s["value"].contains(" ")
    )
    spans = docs.where(text.rlike(_HINTS[2]) | text.rlike(_HINTS[3])).select(
        "id", "hash", F.inline(spaced)
    ).select(
        "id", "hash", F.col("value").alias("word"), "start", "stop",
        _clean(F.regexp_extract("gap", _LAST_WORD, 1)).alias("pattern"),
    )
    return rows.unionByName(spans).where(F.col("pattern") != "")


def discover(
    occurrences: DataFrame, support: int = SUPPORT, confident: float = CONFIDENT,
    accepted: float = ACCEPTED, sole_support: int = SOLE_SUPPORT,
    sole_confident: float = SOLE_CONFIDENT,
) -> DataFrame:
    """(word, kind, score) of instances that no fixed pattern knows."""
    edges = stored(occurrences.select("pattern", "word").distinct(), "edges")
    words = edges.select("word").distinct()
    first = F.get(base_spans(F.col("word")), F.lit(0))["kind"]
    seeds = stored(
        words.select("word", first.alias("kind"), F.lit(1.0).alias("score")).where(
            "kind is not null"
        ), "seeds",
    )
    spark = occurrences.sparkSession
    new = stored(spark.createDataFrame([], "word string, kind int, score double"), "instances")
    seen = (0, 0.0)
    while True:
        known = seeds.unionByName(new).select(F.col("word").alias("w"), "kind", "score")
        joined = edges.join(known, F.col("word") == F.col("w"), "left")
        per_kind = [
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0))
            for k in range(len(KINDS))
        ]
        scored = joined.groupBy("pattern").agg(
            F.count("*").alias("n"), F.count("kind").alias("known"),
            F.array(*per_kind).alias("sums"),
        ).where(F.col("known") >= support)
        best = F.array_max("sums")
        patterns = scored.select(
            F.col("pattern").alias("p"), "known", (best / F.col("n")).alias("confidence"),
            (F.array_position("sums", best) - 1).cast("int").alias("kind"),
        ).where(F.col("confidence") >= confident)
        doubt = F.log(1.0 - F.least(F.col("confidence"), F.lit(0.999)))
        reached = edges.join(patterns, F.col("pattern") == F.col("p")).groupBy(
            "word", "kind"
        ).agg(
            F.count("*").alias("patterns"), (1 - F.exp(F.sum(doubt))).alias("score"),
            F.max((F.col("known") >= sole_support) & (F.col("confidence") >= sole_confident)).alias("sole"),
        )
        better = reached.where(
            ((F.col("patterns") >= 2) | F.col("sole")) & (F.col("score") >= accepted)
        )
        # Of equal scores the kind named first.
        first_best = F.max(F.struct("score", (-F.col("kind")).alias("kind")))
        best_kind = [(-F.col("b.kind")).alias("kind"), F.col("b.score").alias("score")]
        chosen = better.groupBy("word").agg(first_best.alias("b")).select("word", *best_kind)
        # What was accepted stays, so the rounds end.
        both = chosen.join(seeds.select("word"), "word", "left_anti").unionByName(new)
        new = stored(
            both.groupBy("word").agg(first_best.alias("b")).select("word", *best_kind), "instances"
        )
        about = new.agg(F.count("*").alias("n"), F.sum("score").alias("s")).first()
        now = (about["n"], round(about["s"] or 0.0, 3))
        if now == seen:
            return new
        seen = now


def _extra(occurrences: DataFrame, found: DataFrame) -> DataFrame:
    hit = occurrences.join(found.select("word", "kind"), "word")
    span = F.struct("kind", "start", "stop", F.col("word").alias("value"))
    return hit.groupBy("id", "hash").agg(F.sort_array(F.collect_set(span)).alias("extra"))


def find(docs: DataFrame, by: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, hash of the text, base spans and all spans (by kind, then start)."""
    source = docs.select(
        named(by).cast("long").alias("id"), F.coalesce(named(text), F.lit("")).alias("text")
    ).select("id", F.xxhash64("text").alias("hash"), "text")
    occurrences = stored(contexts(source), "occurrences")
    extra = stored(_extra(occurrences, discover(occurrences)), "extra").toDF("_i", "_h", "extra")
    base = source.select("id", "hash", base_spans(F.col("text")).alias("base"))
    joined = base.join(
        extra, F.col("id").eqNullSafe(F.col("_i")) & (F.col("hash") == F.col("_h")), "left"
    )
    added = F.filter("extra", lambda e: ~F.exists(
        "base", lambda b: (b["start"] < e["stop"]) & (e["start"] < b["stop"])
    ))
    spans = F.when(F.col("extra").isNull(), F.col("base")).otherwise(
        F.array_sort(F.concat("base", added))
    )
    return joined.select("id", "hash", "base", spans.alias("spans"))


def redact(docs: DataFrame, by: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; all columns stay.

    Spans that overlap become one, under the name of the first. NULL texts stay NULL.
    """
    source = docs.select(
        named(by).cast("long").alias("id"), F.coalesce(named(text), F.lit("")).alias("text")
    ).select("id", F.xxhash64("text").alias("hash"), "text")
    occurrences = stored(contexts(source), "occurrences")
    extra = stored(_extra(occurrences, discover(occurrences)), "extra")
    i, h, e, s = (free_name(docs, c) for c in ("_id", "_hash", "_extra", "_spans"))
    joined = docs.join(
        extra.toDF(i, h, e), named(by).cast("long").eqNullSafe(F.col(i))
        & (F.xxhash64(F.coalesce(named(text), F.lit(""))) == F.col(h)), "left",
    )
    none = F.array().cast(f"array<{_SPAN}>")
    base = F.when(named(text).isNotNull(), base_spans(named(text))).otherwise(none)
    every = joined.withColumn(s, F.array_sort(
        F.transform(
            F.concat(base, F.coalesce(F.col(e), none)),
            lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind")),
        )
    ))
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def masked_piece(part: Column, at: Column) -> Column:
        """The text from ``at`` to the end of the piece's spans, cut out once and masked."""
        stop = F.aggregate(part, at, lambda m, x: F.greatest(m, x["stop"]))
        own = F.substring(named(text), at + 1, stop - at)  # held in the state: cut out once

        def step(acc, x):
            piece = F.concat(
                F.substring(acc["own"], acc["at"] - acc["base"] + 1, x["start"] - acc["at"]),
                F.get(names, x["kind"]),
            )
            return F.struct(
                F.greatest(acc["at"], x["stop"]).alias("at"),
                F.when(x["start"] >= acc["at"], F.concat(acc["out"], piece)).otherwise(
                    acc["out"]
                ).alias("out"), acc["own"].alias("own"), acc["base"].alias("base"),
            )

        begin = F.struct(at.alias("at"), F.lit("").alias("out"), own.alias("own"), at.alias("base"))
        return F.aggregate(part, begin, step, lambda acc: acc["out"])

    def last_stop(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda m, x: F.greatest(m, x["stop"]))

    def masked_text(pieces: Column) -> Column:
        def joined(stops: Column) -> Column:
            done = F.transform(pieces, lambda part, i: _let(
                F.aggregate(F.slice(stops, 1, i), F.lit(0), lambda m, x: F.greatest(m, x)),
                lambda at: masked_piece(part, at),
            ))
            end = F.aggregate(stops, F.lit(0), lambda m, x: F.greatest(m, x))
            rest = F.substring(named(text), end + 1, F.length(named(text)))
            return F.concat(F.array_join(done, ""), rest)

        return _let(F.transform(pieces, last_stop), joined)

    masked = _let(F.col(s), lambda bound: _let(_chunks(bound), masked_text))
    return every.select(*[
        F.when(F.size(F.col(s)) > 0, masked).otherwise(named(c)).alias(c) if c == text
        else named(c) for c in docs.columns
    ])


def report(docs: DataFrame) -> DataFrame:
    """Per document: base spans by kind, their digest, and all spans as text."""
    found = find(docs)

    def shown(spans: str) -> Column:
        names = F.array(*[F.lit(k) for k in KINDS])
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["stop"]
        )), ",")

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    return found.select(
        F.col("id").alias("doc_id"), *counts,
        F.sha2(shown("base"), 256).alias("base_sha256"), shown("spans").alias("spans"),
    )
