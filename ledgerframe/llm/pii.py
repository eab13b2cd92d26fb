"""Personal data: fixed patterns as seeds, and contexts learned from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, keep

KINDS = ("email", "ip", "card", "phone")
# Matches start only where a run of their first characters does (or a match ended), and
# runs are taken whole: the same matches as without it, in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# grouped digits, seven at least, that stand alone
CANDIDATE = r"(?<![0-9A-Za-z])[0-9](?:[\x20().-]{0,2}[0-9]){6,}+(?![0-9A-Za-z])"
# rounds end earlier if no trust changes any more
ROUNDS = 10
# what a value of unknown kind counts against a pattern, where one of another kind counts 1
UNKNOWN = 0.1
TRUST = 0.8
WEAK = 0.5
SPAN = "array<struct<s:int,e:int,m:string,l:string,r:string>>"


def _spans(text: Column, pattern: str, holds: Column | None = None) -> Column:
    """Matches as structs: s and e (code points, end exclusive), m, and the words l and r
    next to the match on either side, empty where another match or nothing stands there."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def numbered(parts: Column) -> Column:
        n = F.size(parts) - 1
        return F.zip_with(
            F.zip_with(F.slice(parts, 1, n), F.slice(parts, 2, n), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
            found,
            lambda p, m: F.struct(
                F.length(p["a"]).alias("gap"), m.alias("m"),
                # backwards, so that the last word is found at once
                F.lower(F.reverse(F.regexp_extract(F.reverse(p["a"]), r"^[\s(+]*+(\S++)", 1))).alias("l"),
                F.lower(F.regexp_extract(p["b"], r"^[\s)]*+(\S++)", 1)).alias("r"),
            ),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, p: Column) -> Column:
        s = acc["at"] + p["gap"]
        e = s + F.length(p["m"])
        span = F.struct(s.alias("s"), e.alias("e"), p["m"].alias("m"), p["l"].alias("l"), p["r"].alias("r"))
        return F.struct(e.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    listed = F.aggregate(
        F.element_at(F.transform(F.array(between), numbered), 1), start, step, lambda acc: acc["out"]
    )
    none = F.array().cast(SPAN)
    return F.when(text.rlike(pattern) if holds is None else holds, listed).otherwise(none)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]+", "")


def _small(part: Column) -> Column:
    """Whether a run of digits is at most 255."""
    bare = F.regexp_replace(part, "^0+", "")
    return (F.length(bare) <= 3) & (F.coalesce(bare.try_cast("int"), F.lit(0)) <= 255)


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of each kind by the fixed patterns; matches that fail a test are dropped."""
    has_digit = text.rlike("[0-9]")
    size = lambda m: F.length(_digits(m))
    tests = {
        "ip": lambda x: F.forall(F.split(x["m"], r"\."), _small),
        "card": lambda x: size(x["m"]).between(16, 19) & F.call_function("luhn_check", _digits(x["m"])),
        "phone": lambda x: size(x["m"]).between(8, 15),
    }
    found = {
        "email": _spans(text, EMAIL, F.contains(text, F.lit("@"))),
        "ip": _spans(text, IP, has_digit & text.rlike(r"[0-9]\.[0-9]")),
        "card": _spans(text, CARD, has_digit & text.rlike("[0-9][0-9\\x20-]{14}")),
        "phone": _spans(text, PHONE, F.contains(text, F.lit("+")) & has_digit),
    }
    return {k: F.filter(v, tests[k]) if k in tests else v for k, v in found.items()}


def _text_spans(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``(doc_id, h, email, ip, card, phone, cand)``, one row per row; ``h`` is a hash of
    the text, so that rows which repeat an id with other texts are told apart."""
    t = F.col("t")
    rows = docs.select(F.col(key).alias("doc_id"), body(text).alias("t")).select(
        "doc_id", F.xxhash64("t").alias("h"),
        *[v.alias(k) for k, v in base_spans(t).items()],
        _spans(t, CANDIDATE, t.rlike("[0-9]")).alias("cand"),
    )
    taken = F.concat(*KINDS)
    # an array without base spans, the usual case, is not looked through
    free = F.filter("cand", lambda c: ~F.exists(taken, lambda b: (b["s"] < c["e"]) & (c["s"] < b["e"])))
    return rows.withColumn("cand", F.when(F.size("cand") > 0, free).otherwise(F.col("cand")))


def _patterns(value: Column, left: Column, right: Column) -> Column:
    """The lexical patterns an occurrence lies in: its left word, and both its words."""
    return F.filter(
        F.array(
            F.when(left != "", F.concat(left, F.lit(" _"))),
            F.when((left != "") & (right != ""), F.concat(left, F.lit(" _ "), right)),
        ),
        lambda p: p.isNotNull(),
    )


def learn_patterns(spans: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """``(pattern, kind, trust)``: contexts and the kind of data they announce.

    ``spans`` is a table as ``found_spans`` makes it. The graph links every pattern to the
    distinct values it surrounds. A seed's score is 1 for its kind; a candidate's starts
    at 0. In each round a pattern's trust in a kind is the sum of its values' scores over
    that sum, its seeds of other kinds, a tenth (``UNKNOWN``) of what its candidates lack
    of a score, and one; so unseen values neither speak for it nor silence it. A
    candidate's score is what patterns trusted by half or more leave it: 1 less the
    product of their doubts. Rounds end when no trust, of three digits, changes any more,
    at the latest after ``rounds``. Scores and doubts are added up as whole numbers, so
    that results don't depend on the order of rows.
    """
    def of_kind(column: str, kind: Column) -> Column:
        return F.transform(column, lambda x: F.struct(
            kind.alias("kind"), x["m"].alias("m"), x["l"].alias("l"), x["r"].alias("r")
        ))

    seeds = [of_kind(k, F.lit(k)) for k in KINDS]
    unknown = of_kind("cand", F.lit(None).cast("string"))
    seen = spans.select(F.explode(F.concat(*seeds, unknown)).alias("x"))
    edges = keep(
        seen.select(
            F.explode(_patterns(F.col("x.m"), F.col("x.l"), F.col("x.r"))).alias("pattern"),
            F.concat(F.coalesce("x.kind", F.lit("?")), F.lit(":"), "x.m").alias("value"),
            F.col("x.kind").alias("seed"),
        ).distinct()
    )
    is_seed = F.col("seed").isNotNull()
    sizes = keep(edges.groupBy("pattern").agg(F.count_if(is_seed).alias("n_seeds"), F.count_if(~is_seed).alias("n_open")))
    fixed = keep(edges.filter(is_seed).groupBy("pattern", F.col("seed").alias("kind")).agg(
        F.count(F.lit(1)).alias("f")
    ))
    open_edges = keep(edges.filter(~is_seed).select("pattern", "value"))
    # scores in millionths
    given = fixed.select("pattern", "kind", F.lit(0).cast("long").alias("s"))
    trust, before = None, None
    for _ in range(rounds):
        parts = given.select("pattern", "kind", F.lit(0).cast("long").alias("f"), "s").unionAll(
            fixed.select("pattern", "kind", "f", F.lit(0).cast("long"))
        )
        summed = parts.groupBy("pattern", "kind").agg(F.sum("f").alias("f"), (F.sum("s") / 1e6).alias("c"))
        against = F.col("n_seeds") - F.col("f") + UNKNOWN * (F.col("n_open") - F.col("c"))
        for_it = F.col("f") + F.col("c")
        trust = keep(
            summed.join(sizes, "pattern").select(
                "pattern", "kind", F.round(for_it / (for_it + against + 1), 3).alias("trust")
            ).filter(F.col("trust") >= WEAK)
        )
        # trust never falls from one round to the next, so equal sums are equal tables
        now = trust.agg(F.count(F.lit(1)), F.sum(F.round(F.col("trust") * 1000).cast("long"))).first()
        if now == before:
            break
        before = now
        doubt = F.round(F.log(1.000001 - F.col("trust")) * 1e6).cast("long")
        scores = (
            open_edges.join(trust, "pattern").groupBy("value", "kind").agg(F.sum(doubt).alias("d"))
            .select("value", "kind", F.round((1 - F.exp(F.col("d") / 1e6)) * 1e6).cast("long").alias("s"))
        )
        given = open_edges.join(keep(scores), "value").select("pattern", "kind", "s")
    return trust


def discover(spans: DataFrame, trusted: DataFrame, least: float = TRUST) -> DataFrame:
    """``(doc_id, h, kind, s, e)``: candidates in a pattern trusted by ``least`` or more.

    Where several patterns speak, the most trusted decides, then the kind's name.
    """
    cands = spans.filter(F.size("cand") > 0).select("doc_id", "h", F.explode("cand").alias("c")).select(
        "doc_id", "h", "c.s", "c.e", F.explode(_patterns(F.col("c.m"), F.col("c.l"), F.col("c.r"))).alias("pattern")
    )
    best = F.max(F.struct(F.col("trust"), F.col("kind"))).alias("b")
    named = cands.join(trusted.filter(F.col("trust") >= least), "pattern").groupBy("doc_id", "h", "s", "e").agg(best)
    return named.select("doc_id", "h", F.col("b.kind").alias("kind"), "s", "e")


def found_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row: ``doc_id``, ``h``, the base spans of each kind, ``extra``.

    Spans are arrays of structs with start ``s`` and end ``e`` in code points, end
    exclusive, over the whole text; NULL counts as empty. ``extra`` are the discovered
    ones with their ``kind``; they never overlap a base span. Only spans and their
    neighbouring words are written and shuffled, not texts.
    """
    spans = keep(_text_spans(docs, key, text))
    extra = discover(spans, learn_patterns(spans)).groupBy("doc_id", "h").agg(
        F.array_sort(F.collect_set(F.struct("kind", "s", "e"))).alias("extra")
    )
    on = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.h") == F.col("b.h"))
    return spans.alias("a").join(extra.alias("b"), on, "left").select(
        "a.doc_id", "a.h", *KINDS,
        F.coalesce("extra", F.array().cast("array<struct<kind:string,s:int,e:int>>")).alias("extra"),
    )


def all_spans(base_only: bool = False) -> Column:
    """Sorted structs (k, s, e) over the columns of ``found_spans``; k numbers the kinds."""
    def of_kind(column: str, n: int) -> Column:
        return F.transform(column, lambda x: F.struct(F.lit(n).alias("k"), x["s"].alias("s"), x["e"].alias("e")))

    plain = [of_kind(k, n) for n, k in enumerate(KINDS)]
    number = lambda kind: (F.array_position(F.array(*map(F.lit, KINDS)), kind) - 1).cast("int")
    extra = F.transform("extra", lambda x: F.struct(number(x["kind"]).alias("k"), x["s"].alias("s"), x["e"].alias("e")))
    return F.array_sort(F.concat(*plain, *([] if base_only else [extra])))


def span_string(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["k"]), x["s"], x["e"])), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of spans that overlap
    the first gives the name and all are covered."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["k"].alias("k"))))

    def step(acc: Column, x: Column) -> Column:
        end = -x["e"]
        new = x["s"] >= acc["at"]
        piece = F.concat(F.substring(text, acc["at"] + 1, x["s"] - acc["at"]), F.element_at(names, x["k"] + 1))
        return F.struct(
            F.greatest(acc["at"], end).alias("at"),
            F.when(new, F.concat(acc["out"], F.array(piece))).otherwise(acc["out"]).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    done = F.aggregate(
        ordered, start, step,
        lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)


def mask(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with base and discovered spans masked in the texts.

    A column ``n_chars`` is brought up to date; NULL texts without spans stay NULL. Texts
    with discovered spans alone need a join; the others are masked in their row.
    """
    cols = docs.columns
    found = found_spans(docs, key, text).filter(F.size("extra") > 0)
    extra = keep(found.select("doc_id", "h", "extra").distinct())
    keyed = docs.withColumn("__h", F.xxhash64(body(text)))
    on = keyed[key].eqNullSafe(extra["doc_id"]) & (keyed["__h"] == extra["h"])
    # every candidate is a run of seven digits or more
    maybe = F.coalesce(F.col(text).rlike(CANDIDATE), F.lit(False))
    plain = keyed.filter(~maybe).select(*cols, F.lit(None).cast(extra.schema["extra"].dataType).alias("extra"))
    joined = keyed.filter(maybe).join(extra, on, "left").select(*[keyed[c] for c in cols], "extra")
    rows = plain.unionAll(joined)
    rows = rows.select(
        *[F.col(c).alias(f"__{n}") for n, c in enumerate(cols)], F.col(text).alias("t"),
        F.coalesce("extra", F.array().cast("array<struct<kind:string,s:int,e:int>>")).alias("extra"),
        *[v.alias(k) for k, v in base_spans(body(text)).items()],
    )
    clean = F.when(F.col("t").isNotNull(), masked(F.col("t"), F.col("spans")))
    rows = rows.withColumn("spans", all_spans()).withColumn("t", clean)
    new = {text: F.col("t"), "n_chars": F.length("t").cast("long")}
    return rows.select(*[new.get(c, F.col(f"__{n}")).alias(c) for n, c in enumerate(cols)])
