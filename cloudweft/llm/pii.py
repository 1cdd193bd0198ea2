"""Personal data by bootstrapped contextual extraction, with DataFrame operations only.

Seed entities are the base matches (``KINDS``) and hexadecimal strings of the usual lengths of keys (``SECRET``). A
candidate is a run of digit groups, a token with a digit or @, or an address with a spelt-out @, that overlaps no base
match. Seeds and candidates are the instances. Their lexical patterns are the one, two and three tokens before, the word
after, and their own shape (digits as 9, letters as a).

Patterns and instances are scored in turn over their graph, ``ROUNDS`` times. A pattern's score for a kind is the sum of
its instances' scores for that kind, over all that it extracts; it counts with ``SUPPORT`` different likely instances, so
instances that one round finds likely support new patterns in the next. An instance's score is the noisy-or of three
families: what precedes (the best of the three lengths), what follows, and its shape; each is an average over all its
occurrences, in which patterns that do not count are 0. An instance of a shape that seeds have is of that shape's kind, and contexts of
all kinds speak for it; one of another shape needs contexts of one kind. Occurrences of likely instances with a
confident pattern become further spans, those of hexadecimal seeds too, which no base rule has.

Places are code points, ends exclusive. Matches come from ``regexp_extract_all`` and the gaps between them from
``split`` by the same pattern, so a place is a running sum over a document's own matches.

Defined results: a null or empty text has no spans; texts of any length are taken whole; repeated rows get equal
results; of kinds that are equally likely the first counts; an empty table gives an empty result; columns named base and
more, in whatever case, are replaced, and other columns than those kept are not read. The regular expressions are possessive where this changes
no match, so that long runs need neither stack nor backtracking.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from cloudweft.llm.common import SPACE_CLASS, column, discard, others, tables, written

KINDS = ("email", "ip", "card", "phone")
SECRET = "secret"
CANDIDATE = "candidate"
#: Kinds that the graph scores, in the order of their ranks.
SCORED = (*KINDS, SECRET)
ROUNDS = 3
#: Likely instances that a pattern must extract; the least score of a confident pattern and of a likely instance. Patterns
#: of half that score speak for instances too.
SUPPORT = 3
PATTERN_SCORE = 0.5
INSTANCE_SCORE = 0.5
#: Characters and digits that a candidate has at least; digits are not asked for where there is an @.
SHORTEST = 5
DIGITS = 4
#: Patterns are broadcast if there are at most so many, otherwise shuffled.
BROADCAST_PATTERNS = 500_000
#: The tokens before an instance are looked for in so many pieces between white-space characters.
PIECES = 12

_LOCAL = "A-Za-z0-9._%+-"
_OPEN = r"\"'(\[{<:=,;|"
_AT = r"(?:@|[\[({]\x20?(?i:at|@)\x20?[\])}])"
_DOT = r"(?:\.|\x20?[\[({]\x20?(?i:dot|\.)\x20?[\])}]\x20?)"
_RUN = rf"[+(]*+[0-9][0-9().\x20/+-]*[0-9)](?![^{SPACE_CLASS}.,;:!?)\]}}\"'<>|*#$%&])"
_ADDRESS = rf"[{_LOCAL}]++\x20?{_AT}\x20?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"
_TOKEN = rf"[^{SPACE_CLASS}0-9@{_OPEN}]*+[0-9@][^{SPACE_CLASS}\"'<>|]*+"
#: A run that starts in the middle was tried from its start already, unless a match has just ended there (\G).
REGEX = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    CANDIDATE: rf"(?<![^{SPACE_CLASS}{_OPEN}])(?:{_ADDRESS}|{_RUN}|{_TOKEN})",
}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_HEX = r"^(?=.*[0-9])(?=.*[a-f])(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64})$"


def possible(kind: str, text: Column) -> Column:
    """False only where there is no valid match: spares most texts the search."""
    return {
        "email": text.contains("@"),
        "ip": text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"),
        "card": text.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
        "phone": text.contains("+"),
        CANDIDATE: text.rlike(rf"[0-9@]|{_AT}"),
    }[kind]


def valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]", "")
    return (
        F.when(kind == "ip", match.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"))
        .when(kind == "card", F.length(digits).between(14, 19) & F.call_function("luhn_check", digits))
        .when(kind == "phone", F.length(digits).between(10, 15))
        .otherwise(F.lit(True))
    )


def before(gap: Column) -> Column:
    """Up to three tokens before the end of a gap, the last one first; digits count as one 0."""
    plain = F.substring_index(F.rtrim(F.translate(gap, "\t\n\u000b\f\r", "     ")), " ", -PIECES)
    tokens = F.filter(F.split(F.regexp_replace(F.lower(plain), "[0-9]+", "0"), " "), lambda x: x != "")
    return F.slice(F.reverse(tokens), 1, 3)


def after(gap: Column) -> Column:
    """The word that a gap begins with, but for a few other characters."""
    return F.lower(F.regexp_extract(gap, r"^[^\p{L}\p{N}]{0,8}+([\p{L}\p{N}]++)", 1))


def shape(instance: Column) -> Column:
    hexadecimal = instance.rlike("^[0-9a-f]{16,}$") & instance.rlike("[a-f]")
    return F.when(hexadecimal, F.concat(F.lit("hex "), F.length(instance).cast("string"))).otherwise(F.regexp_replace(F.translate(instance, "012345678", "999999999"), r"\p{L}+", "a"))


def matches(docs: DataFrame, text_col: str, kept: list[str]) -> DataFrame:
    """doc (the ``kept`` columns), row (a number for each row), and for each kind an array of (gap, left, right, match)."""
    text = column(text_col)
    first = [F.struct(*map(column, kept)).alias("doc") if kept else F.struct(F.lit(0).alias("none")).alias("doc"), F.monotonically_increasing_id().alias("row")]
    cut = [F.when(possible(kind, text), F.split(text, regex, -1)).alias(f"{kind}_gaps") for kind, regex in REGEX.items()]
    found = [F.when(possible(kind, text), F.regexp_extract_all(text, F.lit(regex), F.lit(0))).alias(f"{kind}_found") for kind, regex in REGEX.items()]

    def together(kind: str) -> Column:
        gaps = F.col(f"{kind}_gaps")
        rows = F.arrays_zip(gaps.alias("gap"), F.col(f"{kind}_found").alias("match"), F.slice(gaps, 2, 1 << 30).alias("next"))
        rows = F.filter(rows, lambda x: x["match"].isNotNull())
        return F.transform(rows, lambda x: F.struct(F.length(x["gap"]).alias("gap"), before(x["gap"]).alias("left"), after(x["next"]).alias("right"), x["match"].alias("match"))).alias(kind)

    return docs.select(*first, *cut, *found).select("doc", "row", *map(together, REGEX))


def placed(table: DataFrame) -> DataFrame:
    """(row, kind, rank, start, end, left, right, match) of all matches, in no order."""
    parts = [table.select("row", F.lit(kind).alias("kind"), F.lit(k).alias("rank"), F.posexplode(kind).alias("at", "m")) for k, kind in enumerate(REGEX)]
    every = reduce(DataFrame.unionByName, parts).select("row", "kind", "rank", "at", "m.*")
    upto = Window.partitionBy("row", "kind").orderBy("at")
    end = F.sum(F.col("gap") + F.length("match")).over(upto.rowsBetween(Window.unboundedPreceding, 0))
    return every.withColumn("end", end).select("row", "kind", "rank", (F.col("end") - F.length("match")).alias("start"), "end", "left", "right", "match")


def spans(table: DataFrame) -> DataFrame:
    """(row, kind, rank, start, end, instance, patterns) of valid base matches, and of candidates that overlap none of them."""
    found = placed(table).where(valid(F.col("kind"), F.col("match")))
    base = F.col("kind") != CANDIDATE
    order = Window.partitionBy("row").orderBy("start", "end", "rank")
    ahead = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    behind = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    trimmed = F.regexp_replace("match", r"[.,;:!?)\]}'\"*#$%&]+$", "")
    found = found.withColumn("ahead", ahead).withColumn("behind", behind)
    found = found.withColumn("match", F.when(base, F.col("match")).otherwise(trimmed)).withColumn("end", F.when(base, F.col("end")).otherwise(F.col("start") + F.length("match")))
    clear = (F.coalesce("behind", F.lit(0)) <= F.col("start")) & (F.coalesce("ahead", F.col("end")) >= F.col("end"))
    digits = F.length(F.regexp_replace("match", "[^0-9]", ""))
    clear &= (F.length("match") >= SHORTEST) & ((digits >= DIGITS) | F.col("match").rlike(_AT))
    left, instance = F.col("left"), F.lower("match")
    own = [F.when(F.size(left) >= k, F.xxhash64(F.lit(f"left {k}"), F.slice(left, 1, k))) for k in (1, 2, 3)]
    own += [F.when(F.col("right") != "", F.xxhash64(F.lit("right"), "right")), F.xxhash64(F.lit("shape"), shape(instance))]
    return found.where(base | clear).select("row", "kind", "rank", "start", "end", instance.alias("instance"), F.array(*own).alias("patterns"))


#: Places of the families in ``patterns``.
LEFTS, RIGHT, SHAPE = (0, 1, 2), 3, 4


def graph(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (pattern, family, instance, kind, n, total) of patterns with ``SUPPORT`` instances or more, total being the
    occurrences of the instance; and (instance, q0, ..) of candidates whose shape enough seeds have: the shares of kinds among these."""
    every = found.select("instance", "kind", F.posexplode("patterns").alias("family", "pattern")).where("pattern is not null")
    every = written(every.groupBy("pattern", "family", "instance", "kind").agg(F.count("*").alias("n")), "edges")
    seed = F.col("kind") != CANDIDATE
    counts = [F.sum(F.when(F.col("kind") == k, 1).otherwise(0)).alias(f"c{i}") for i, k in enumerate(KINDS)]
    counts.append(F.sum(F.when(~seed & F.col("instance").rlike(_HEX), 1).otherwise(0)).alias(f"c{len(KINDS)}"))
    known = written(every.groupBy("pattern").agg(F.count("*").alias("m"), *counts).where(F.col("m") >= SUPPORT), "known")
    side = F.broadcast(known) if known.count() <= BROADCAST_PATTERNS else known
    totals = every.where(F.col("family") == SHAPE).select("instance", "kind", F.col("n").alias("total"))  # each occurrence has one shape
    edges = written(every.join(side.select("pattern"), "pattern", "left_semi").join(totals, ["instance", "kind"]), "graph")
    seeds = sum((F.col(f"c{i}") for i in range(1, len(SCORED))), F.col("c0"))
    shapes = side.where(seeds >= SUPPORT).select("pattern", *((F.col(f"c{i}") / seeds).alias(f"q{i}") for i in range(len(SCORED))))
    shaped = edges.where((F.col("family") == SHAPE) & ~seed).select("pattern", "instance").join(shapes, "pattern").drop("pattern")
    return edges, written(shaped, "shapes")


def lexical(edges: DataFrame, scores: DataFrame | None) -> DataFrame:
    """(pattern, p0, ..): the score of each pattern that counts, for each kind. ``scores`` has (instance, s0, ..) of candidates."""
    seed = F.col("kind") != CANDIDATE
    own = [F.when(F.col("kind") == k, 1.0).otherwise(0.0) for k in KINDS] + [F.when(~seed & F.col("instance").rlike(_HEX), 1.0).otherwise(0.0)]
    if scores is not None:
        edges = edges.join(scores.withColumn("kind", F.lit(CANDIDATE)), ["instance", "kind"], "left")
        own = [F.greatest(x, F.coalesce(f"s{i}", F.lit(0.0))) for i, x in enumerate(own)]
    each = edges.select("pattern", "n", *(x.alias(f"s{i}") for i, x in enumerate(own)))
    whole = sum((F.col(f"s{i}") for i in range(1, len(SCORED))), F.col("s0"))
    sums = each.groupBy("pattern").agg(F.sum("n").alias("n"), F.sum(F.when(whole >= INSTANCE_SCORE, 1).otherwise(0)).alias("likely"), *(F.sum(F.col("n") * F.col(f"s{i}")).alias(f"s{i}") for i in range(len(SCORED))))
    out = sums.where(F.col("likely") >= SUPPORT).select("pattern", *((F.col(f"s{i}") / (F.col("n") + 1.0)).alias(f"p{i}") for i in range(len(SCORED))))
    return out.where(score_of(out) >= PATTERN_SCORE / 2)


def score_of(patterns: DataFrame) -> Column:
    return sum((patterns[f"p{i}"] for i in range(1, len(SCORED))), patterns["p0"])


def instances(edges: DataFrame, patterns: DataFrame, shaped: DataFrame) -> DataFrame:
    """(instance, s0, ..) of candidates that a pattern speaks for."""
    side = F.broadcast(patterns) if patterns.count() <= BROADCAST_PATTERNS else patterns
    loose = edges.where(F.col("kind") == CANDIDATE).join(side, "pattern")
    cells = [(f, i) for f in range(SHAPE + 1) for i in range(len(SCORED))]
    share = F.col("n") / F.col("total")
    sums = loose.groupBy("instance").agg(*(F.sum(F.when(F.col("family") == f, share * F.col(f"p{i}")).otherwise(0.0)).alias(f"m{f}_{i}") for f, i in cells))

    def noisy_or(m: list[Column]) -> Column:
        ahead = F.greatest(*(m[f] for f in LEFTS))
        return 1.0 - (1.0 - ahead) * (1.0 - m[RIGHT]) * (1.0 - m[SHAPE])

    alone = [noisy_or([F.col(f"m{f}_{i}") for f in range(SHAPE + 1)]) for i in range(len(SCORED))]
    every = noisy_or([sum((F.col(f"m{f}_{i}") for i in range(1, len(SCORED))), F.col(f"m{f}_0")) for f in range(SHAPE + 1)])
    best = F.greatest(*alone)
    first = [F.lit(True), *(F.greatest(*alone[:i]) < alone[i] if i > 1 else alone[0] < alone[1] for i in range(1, len(SCORED)))]
    scored = sums.select("instance", every.alias("every"), *(F.when((x == best) & f, x).otherwise(0.0).alias(f"a{i}") for i, (x, f) in enumerate(zip(alone, first, strict=True))))
    both = scored.join(shaped, "instance", "left")
    return both.select("instance", *(F.when(F.col("q0").isNotNull(), F.col("every") * F.col(f"q{i}")).otherwise(F.col(f"a{i}")).alias(f"s{i}") for i in range(len(SCORED))))


def discovered(found: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(row, kind, rank, start, end) of occurrences of likely instances that have a confident pattern."""
    spark, mark = found.sparkSession, tables()
    edges, shaped = graph(found)
    scores, patterns = None, None
    for k in range(rounds):
        patterns = written(lexical(edges, scores), f"lexical{k}")
        scores = written(instances(edges, patterns, shaped), f"instances{k}")
    confident = patterns.where(score_of(patterns) >= PATTERN_SCORE).select("pattern")
    side = F.broadcast(confident) if confident.count() <= BROADCAST_PATTERNS else confident
    whole = sum((F.col(f"s{i}") for i in range(1, len(SCORED))), F.col("s0"))
    most = F.greatest(*(F.col(f"s{i}") for i in range(len(SCORED))))
    rank = F.coalesce(*(F.when(F.col(f"s{i}") == most, i) for i in range(len(SCORED))))
    likely = scores.where(whole >= INSTANCE_SCORE).select("instance", rank.alias("rank"))
    places = found.where(F.col("kind") == CANDIDATE).select("row", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    sure = places.join(side, "pattern", "left_semi").select("row", "start", "end", "instance").distinct()
    names = F.element_at(F.array(*map(F.lit, SCORED)), F.col("rank") + 1)
    out = written(sure.join(likely, "instance").select("row", names.alias("kind"), "rank", "start", "end"), "discovered")
    discard(spark, mark, out)
    return out


def joined(items: Column) -> Column:
    """kind:start:end of structs (start, rank, end, kind), in order, with commas."""
    return F.array_join(F.transform(F.array_sort(items), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def extract(docs: DataFrame, text_col: str = "text", kept: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``kept`` columns, then base and more: arrays of (start, rank, end, kind)."""
    names = [c for c in others(docs, "base", "more") if c in kept]
    table = written(matches(docs, text_col, names), "matches")
    found = written(spans(table), "spans")
    base = found.where(F.col("kind") != CANDIDATE).select("row", F.lit(True).alias("base"), "start", "rank", "end", "kind")
    more = discovered(found).select("row", F.lit(False).alias("base"), "start", "rank", "end", "kind")
    item = F.struct("start", "rank", "end", "kind")
    by_row = base.unionByName(more).groupBy("row").agg(F.collect_list(F.when(F.col("base"), item)).alias("base"), F.collect_list(F.when(~F.col("base"), item)).alias("more"))
    empty = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")
    out = table.select("doc", "row").join(by_row, "row", "left")
    return out.select(*(F.col("doc").getField(c).alias(c) for c in names), F.coalesce("base", empty).alias("base"), F.coalesce("more", empty).alias("more"))


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return found.select("doc_id", *(count(kind).alias(f"n_{kind}") for kind in KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_more"))
