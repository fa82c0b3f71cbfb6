"""Personal data by bootstrapped contextual extraction [DataFrame functions only].

Base patterns find mail addresses, IP addresses, card and phone numbers. They are the seeds: the words
around them are lexical patterns ("words before _", "word before _ word after"). Tokens that look like
identifiers, seeds or not, are the instances. On the graph of patterns and instances, Spark scores in
turn: a pattern's confidence in a kind is the mean score of the instances it surrounds, an instance's score
the chance that one of its confident patterns is right. Tokens of fitting shape that confident patterns
surround are added as spans of the kind; base spans always stay.

Positions come from splitting a text at the matches and adding up lengths, so every text is read whole, in
its own row, and only short mention rows are shuffled. The patterns are written without the backtracking
that would make long runs of letters or digits quadratic.

Cases: a null text counts as empty and has no spans. Rows that repeat ``doc_id`` and text get the same
spans; equal ids with different texts are kept apart by a hash of the text. Extra columns are ignored by
:func:`find` and carried by :func:`redact`.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.llm.common import Run, join_hot, read

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
#: Same matches as the plain forms, found in linear time: runs are possessive and entered at their start
#: only (or where the last match ended).
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must contain for a pattern to be tried.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
#: Shapes that a token must have to be counted for a kind and added as its span.
SHAPES = {
    "email": r"^[^@]+@[^@]+$", "ip": r"^([0-9]+(\.[0-9]+){3}|[0-9A-Fa-f]*(:[0-9A-Fa-f]*){2,})$",
    "card": r"^[0-9]([ -]?[0-9]){11,18}$", "phone": r"^\+?([ ().-]*[0-9]){7,15}$",
}
CONTEXT = 80  # characters beside a mention in which its context words are looked for
SUPPORT, CONFIDENCE, ROUNDS = 3.0, 0.8, 2
_BLOCK = 256


def _running(lengths: Column) -> Column:
    """Running sums of an array. Blocks keep the copying of growing arrays short for long arrays."""
    fold = lambda values, first: F.aggregate(
        values, F.struct(first.alias("s"), F.array().cast("array<bigint>").alias("a")),
        lambda acc, x: F.struct((acc["s"] + x).alias("s"), F.concat(acc["a"], F.array(acc["s"] + x)).alias("a")),
        lambda acc: acc["a"],
    )
    block = lambda b: F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))
    zero = F.lit(0).cast("bigint")
    numbers = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _BLOCK).cast("int"))
    before = fold(F.transform(numbers, lambda b: F.aggregate(block(b), zero, lambda acc, x: acc + x)), zero)
    parts = F.zip_with(numbers, before, lambda b, upto: F.struct(b.alias("b"), upto.alias("upto")))
    whole = F.flatten(F.transform(parts, lambda p: fold(
        block(p["b"]), p["upto"] - F.aggregate(block(p["b"]), zero, lambda acc, x: acc + x))))
    return F.when(F.size(lengths) > _BLOCK, whole).otherwise(fold(lengths, zero))


def _with_matches(df: DataFrame, name: str, pattern: str, tried: Column) -> DataFrame:
    """Add array ``name`` of (match, before, after, start, end): all matches in ``text`` with the text beside
    them up to the next matches, positions in code points."""
    found, pieces = f"_{name}", f"_{name}_pieces"
    none = F.array().cast("array<string>")
    df = df.withColumn(found, F.when(tried, F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).otherwise(none))
    df = df.withColumn(pieces, F.when(F.size(found) > 0, F.split("text", pattern, -1)).otherwise(none))
    lengths = F.zip_with(
        F.slice(pieces, 1, F.size(found)), F.concat(F.array(F.lit("")), F.slice(found, 1, F.greatest(F.size(found) - 1, F.lit(0)))),
        lambda piece, before: (F.length(piece) + F.length(before)).cast("bigint"),
    )
    df = df.withColumn(f"{found}_lengths", lengths)
    df = df.withColumn(f"{found}_starts", F.when(F.size(found) > 0, _running(F.col(f"{found}_lengths"))).otherwise(F.array().cast("array<bigint>")))
    cut = F.transform(
        F.arrays_zip(
            F.col(found).alias("match"), F.transform(F.slice(pieces, 1, F.size(found)), lambda x: F.substring(x, -CONTEXT, CONTEXT)).alias("before"),
            F.transform(F.slice(pieces, 2, F.size(found)), lambda x: F.substring(x, 1, CONTEXT)).alias("after"),
            F.col(f"{found}_starts").alias("start"),
        ),
        lambda m: F.struct(m["match"].alias("match"), m["before"].alias("before"), m["after"].alias("after"),
                           m["start"].alias("start"), (m["start"] + F.length(m["match"])).alias("end")),
    )
    return df.withColumn(name, F.when(F.size(found) > 0, cut).otherwise(F.array().cast(
        "array<struct<match:string,before:string,after:string,start:bigint,end:bigint>>"))).drop(
        found, pieces, f"{found}_lengths", f"{found}_starts")


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    last = F.reverse(digits)
    doubled = lambda i, x: F.when(i % 2 == 1, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))
    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits)), F.lit(0),
        lambda acc, i: acc + doubled(i, F.substr(last, i, F.lit(1)).cast("int")),
    )
    return total % 10 == 0


def _valid(kind: str):
    """What a match must also be."""
    part = lambda x: F.regexp_like(x, F.lit("^0*(25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$"))
    return {
        "email": lambda m: F.lit(True),
        "ip": lambda m: F.forall(F.split(m["match"], r"\."), part),
        "card": lambda m: F.when(F.length(_digits(m["match"])).between(12, 19), _luhn(_digits(m["match"]))).otherwise(False),
        "phone": lambda m: F.length(_digits(m["match"])).between(9, 15),
    }[kind]


def _words(context: Column) -> Column:
    lower = F.translate(context, string.ascii_uppercase, string.ascii_lowercase)
    return F.split(F.trim(F.regexp_replace(F.regexp_replace(lower, "[0-9]+", "0"), r"[\x20\x09-\x0D]+", " ")), " ")


def _mentions(kind: str, matches: Column, instance) -> Column:
    """(kind, instance, start, end, patterns) of each match."""
    beside = F.transform(matches, lambda m: F.struct(
        instance(m).alias("instance"), m["start"].alias("start"), m["end"].alias("end"),
        _words(m["before"]).alias("before"), _words(m["after"]).alias("after")))
    last = lambda m: F.element_at(m["before"], -1)
    second = lambda m: F.coalesce(F.try_element_at(m["before"], F.lit(-2)), F.lit("^"))
    return F.transform(beside, lambda m: F.struct(
        F.lit(kind).alias("kind"), m["instance"].alias("instance"), m["start"].alias("start"), m["end"].alias("end"),
        F.when(last(m) != "", F.array(F.concat(second(m), F.lit(" "), last(m), F.lit(" _")),
                                      F.concat(last(m), F.lit(" _ "), F.element_at(m["after"], 1))))
        .otherwise(F.array().cast("array<string>")).alias("patterns")))


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, base, mentions) per row: the valid base matches, and every mention of a seed or of a token
    that looks like an identifier, with its patterns."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("mark", F.xxhash64("text"))
    rows = rows.withColumn("_digits", F.regexp_like("text", F.lit("[0-9]")))
    for kind in KINDS:
        hint = F.col("_digits") if kind != "email" else F.lit(True)
        rows = _with_matches(rows, kind, PATTERNS[kind], hint & F.contains("text", F.lit(HINTS[kind])) if HINTS[kind] else hint)
        rows = rows.withColumn(kind, F.filter(kind, _valid(kind)))
    rows = _with_matches(rows, "token", TOKEN, F.col("_digits") | F.contains("text", F.lit("@")))
    core = lambda m: F.regexp_replace(m["match"], r"^[\p{Punct}&&[^+(]]+|[\p{Punct}]+$", "")
    tokens = F.filter("token", lambda m: F.contains(m["match"], F.lit("@")) | (F.length(_digits(m["match"])) >= 5))
    span = lambda kind: F.transform(kind, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind")))
    mentions = [_mentions(kind, F.col(kind), lambda m: m["match"]) for kind in KINDS]
    return rows.select(
        "doc_id", "mark", F.array_sort(F.concat(*map(span, KINDS))).alias("base"),
        F.concat(*mentions, _mentions("", tokens, core)).alias("mentions"),
    )


def _scores(mentions: DataFrame, run: Run, rounds: int) -> DataFrame:
    """Confident patterns (key, confidence, degree), where a key is a pattern and a kind: the graph scored
    ``rounds`` times. An instance and a pattern meet once for each kind whose shape the instance has."""
    fitting = F.array_compact(F.array(*[F.when(F.regexp_like("instance", F.lit(SHAPES[k])), F.lit(k)) for k in KINDS]))
    edges = run.write(
        mentions.select("pattern", "instance").distinct().select("pattern", "instance", F.explode(fitting).alias("kind"))
        .select(F.concat_ws(":", "kind", "pattern").alias("key"), F.concat_ws(":", "kind", "instance").alias("member")),
        "edges",
    )
    size = edges.count()
    degrees = edges.groupBy("key").agg(F.count(F.lit(1)).alias("degree"))
    seeds = mentions.where("kind <> ''").select(F.concat_ws(":", "kind", "instance").alias("member")).distinct()
    scores = seeds = seeds.withColumn("score", F.lit(1.0))
    for turn in range(1, rounds + 1):
        spread = edges.groupBy("member").agg(F.count(F.lit(1)).alias("spread"))
        known = run.write(scores.join(spread, "member"), f"scores-{turn}")
        support = join_hot(edges, known, "member", "spread", size).groupBy("key").agg(F.sum("score").alias("support"))
        confident = run.write(
            support.where(F.col("support") >= SUPPORT).join(degrees, "key")
            .withColumn("confidence", F.least(F.lit(1.0), F.col("support") / F.col("degree")))
            .where(F.col("confidence") >= CONFIDENCE).select("key", "confidence", "degree"),
            f"confident-{turn}",
        )
        if turn < rounds:
            found = join_hot(edges, confident, "key", "degree", size).groupBy("member").agg(
                (1 - F.exp(F.sum(F.log(1.000001 - F.col("confidence"))))).alias("score"))
            scores = seeds.unionByName(found).groupBy("member").agg(F.max("score").alias("score"))
    return confident


def find(docs: DataFrame, run: Run, *, rounds: int = ROUNDS) -> DataFrame:
    """Per row of ``docs``: doc_id, mark, base and spans, both arrays of (start, rank, end, kind) in order."""
    rows = run.write(base_spans(docs), "base")
    mentions = run.write(
        rows.where(F.size("mentions") > 0).select("doc_id", "mark", F.explode("mentions").alias("m"))
        .select("doc_id", "mark", "m.kind", "m.instance", "m.start", "m.end", F.explode("m.patterns").alias("pattern")),
        "mentions",
    )
    confident = _scores(mentions, run, rounds)
    fitting = F.array_compact(F.array(*[F.when(F.regexp_like("instance", F.lit(SHAPES[k])), F.lit(k)) for k in KINDS]))
    tokens = mentions.where("kind = ''").withColumn("kind", F.explode(fitting)).withColumn("key", F.concat_ws(":", "kind", "pattern"))
    added = (
        tokens.join(confident, "key")
        .groupBy("doc_id", "mark", "start", "end").agg(F.max(F.struct("confidence", "kind"))["kind"].alias("kind"))
        .groupBy("doc_id", "mark").agg(F.collect_set(F.struct(
            "start", F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int").alias("rank"), "end", "kind")).alias("added"))
        .withColumnsRenamed({"doc_id": "_doc", "mark": "_mark"})
    )
    joined = rows.drop("mentions").join(added, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left")
    new = F.transform(
        F.filter("added", lambda a: ~F.exists("base", lambda b: (b["start"] < a["end"]) & (a["start"] < b["end"]))),
        lambda a: F.struct(a["start"].alias("start"), (a["rank"] - 1).alias("rank"), a["end"].alias("end"), a["kind"].alias("kind")),
    )
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", new)))
    return joined.select("doc_id", "mark", "base", spans.alias("spans"))


def as_text(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with every span of :func:`find` replaced by its kind in angle brackets; overlapping spans become one."""
    spans = found.where(F.size("spans") > 0).select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "spans")
    spans = spans.groupBy("_doc", "_mark").agg(F.first("spans").alias("_spans"))
    joined = docs.join(
        spans, docs["doc_id"].eqNullSafe(F.col("_doc")) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_mark")), "left")
    text = docs["text"]
    done = F.aggregate(
        "_spans", F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out")),
        lambda acc, s: F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(
            F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.concat(F.lit("<"), s["kind"], F.lit(">")))).alias("out")))
        .otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, (acc["at"] + 1).cast("int"))),
    )
    return joined.select(*[F.when(F.col("_spans").isNull(), text).otherwise(done).alias("text") if c == "text" else docs[c] for c in docs.columns])


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole ``documents``: how many base matches of each kind, and all spans."""
    found = find(read(spark, sf_dir, "documents"), Run(spark, "op9"))
    of = lambda kind: lambda s: s["kind"] == kind
    counts = [F.size(F.filter("base", of(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(as_text("base"), 256).alias("base_sha256"), as_text("spans").alias("spans"))
