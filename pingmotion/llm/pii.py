"""Personal data: base patterns, and terms that disclose them by corpus co-occurrence.

Base spans are emails, addresses, cards and phones by fixed patterns. Each distinct value is a
protected entity. A term (a run of letters outside base spans) discloses an entity as far as their
pointwise mutual information comes up to the information content of the entity:
``PMI(t; e) = log(N n(t,e) / (n(t) n(e)))`` against ``IC(e) = log(N / n(e))``, with counts of
documents over the whole corpus. At the full content the term never occurs without the entity. Terms
at or above the share ``SHARE`` with at least ``SUPPORT`` common documents are spans as well, wherever
they stand: far from the entity, and in documents without it. An entity in fewer than ``SUPPORT``
documents has no terms.

All of it is DataFrame functions. Offsets are code points: a pattern's matches are fenced with a
private-use character, the text is split at the fences and the lengths are summed. The corpus counts
of terms run over all documents; terms that cannot come up to the share are dropped inside the scans
by bitmaps of fixed size, so only candidates are shuffled. As ``n(t,e) <= n(e)``, a term of more than
``n(e) (N / n(e)) ** (1 - SHARE)`` documents cannot disclose ``e``; only the others are paired with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import bitmap, marked, stored

SHARE, SUPPORT = 0.9, 3
#: shortest term
TERM_LETTERS = 4
TERM_PATTERN = rf"\p{{L}}{{{TERM_LETTERS},}}"
FENCE, STAND_IN = "\ue000", "\ue001"
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
# The fixed patterns. A search that starts within a run cannot succeed where the start of the run
# failed, so it may only start there or where the last match ended (\G); with possessive loops,
# long runs then cost their length once. A card's bounds of 12 to 19 digits are part of the
# pattern, because its run is as long as it can be in any case.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?+[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_WORTH_A_LOOK = {"email": "@", "phone": "+"}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        return F.call_function("luhn_check", _digits(value))
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def _matches(text: Column, pattern: str, keep) -> Column:
    """``array<struct<start, end, value>>`` of the matches that ``keep``; ``text`` has no fence."""
    return _fenced(F.regexp_replace(text, pattern, f"{FENCE}$0{FENCE}"), keep)


def _fenced(text: Column, keep) -> Column:
    """``array<struct<start, end, value>>`` of the fenced stretches that ``keep``."""
    return F.aggregate(
        F.split(text, FENCE),
        F.struct(
            F.lit(0).alias("at"),
            F.lit(False).alias("hit"),
            F.expr("cast(array() AS array<struct<start:int,end:int,value:string>>)").alias("found"),
        ),
        lambda s, x: F.struct(
            (s["at"] + F.length(x)).alias("at"),
            (~s["hit"]).alias("hit"),
            F.when(
                s["hit"] & keep(x),
                F.array_append(
                    s["found"],
                    F.struct(s["at"].alias("start"), (s["at"] + F.length(x)).alias("end"), x.alias("value")),
                ),
            )
            .otherwise(s["found"])
            .alias("found"),
        ),
        lambda s: s["found"],
    )


def base_spans(text: Column) -> Column:
    """``array<struct<start, kind_no, kind, end, value>>`` of a text without nulls, in order."""
    clean = F.translate(text, FENCE, STAND_IN)
    none = F.expr("cast(array() AS array<struct<start:int,kind_no:int,kind:string,end:int,value:string>>)")

    def of(number: int, kind: str) -> Column:
        hint = text.contains(_WORTH_A_LOOK[kind]) if kind in _WORTH_A_LOOK else text.rlike("[0-9]")
        found = _matches(clean, PATTERNS[kind], lambda x: F.coalesce(_valid(kind, x), F.lit(False)))
        named = F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"),
                F.lit(number).alias("kind_no"),
                F.lit(kind).alias("kind"),
                s["end"].alias("end"),
                s["value"].alias("value"),
            ),
        )
        return F.when(hint, named).otherwise(none)

    every = [of(number, kind) for number, kind in enumerate(KINDS)]
    return F.array_sort(F.concat(*every))


def _outside(text: Column) -> Column:
    """The text with emails, the only base spans with letters, blanked at their length."""
    clean = F.translate(text, FENCE, STAND_IN)
    parts = F.split(F.regexp_replace(clean, PATTERNS["email"], f"{FENCE}$0{FENCE}"), FENCE)
    blank = F.transform(parts, lambda x, i: F.when(i % 2 == 1, F.repeat(F.lit(STAND_IN), F.length(x))).otherwise(x))
    return F.when(text.contains(_WORTH_A_LOOK["email"]), F.array_join(blank, "")).otherwise(clean)


def _terms(outside: Column) -> Column:
    """The distinct terms of a text, folded."""
    found = F.array_distinct(F.regexp_extract_all(outside, F.lit(f"({TERM_PATTERN})"), F.lit(1)))
    return F.array_distinct(F.transform(found, F.lower))


def _marked_terms(outside: Column, bits: Column) -> Column:
    """``array<struct<start, end, value>>`` of every occurrence of a term that ``bits`` may hold."""
    parts = F.split(F.regexp_replace(outside, TERM_PATTERN, f"{FENCE}$0{FENCE}"), FENCE)
    fenced = F.transform(
        parts,
        lambda x, i: F.when((i % 2 == 1) & marked(bits, F.lower(x)), F.concat(F.lit(FENCE), x, F.lit(FENCE))).otherwise(x),
    )
    return _fenced(F.array_join(fenced, ""), lambda x: F.lit(True))


def private_spans(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` columns named in ``keep`` (default doc_id) with ``base`` and ``spans``, both
    ``array<struct<start, kind_no, kind, end, value>>`` in order of start and kind.

    ``spans`` are the base spans and those of disclosing terms. Null and empty texts have none.
    Repeated rows count as so many documents; each is returned. Fence characters in a text are
    read as another private-use character, which is in no pattern.
    """
    keep = keep or ["doc_id"]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    names = [f"k_{i}" for i in range(len(keep))]
    own = [] if "text" in keep else [F.col("text").cast("string").alias("t")]
    rows = stored(
        docs.select(*[F.col(c).alias(k) for c, k in zip(keep, names)], *own, base_spans(text).alias("base")).withColumn(
            "row", F.monotonically_increasing_id()
        ),
        "spans",
    )
    stored_text = F.col(names[keep.index("text")] if "text" in keep else "t").cast("string")
    outside = _outside(F.coalesce(stored_text, F.lit("")))
    total = float(max(rows.count(), 1))

    named = F.array_distinct(F.transform("base", lambda s: F.concat(s["kind"], F.lit(":"), F.lower(s["value"]))))
    held = rows.where(F.size("base") > 0).select("row", F.explode(named).alias("entity"))
    entities = held.groupBy("entity").agg(F.count("*").alias("n_e")).where(f"n_e >= {SUPPORT}")
    # the most documents that a disclosing term of the entity can have, and a little for rounding
    most = F.col("n_e") * F.pow(F.lit(total) / F.col("n_e"), F.lit(1 - SHARE)) * 1.000001
    entities = stored(entities.withColumn("most", most), "entities")
    # a row's entities are folded to one array, so that a pair is only made where it may count
    holding = stored(
        held.join(entities, "entity").groupBy("row").agg(F.collect_list(F.struct("entity", "n_e", "most")).alias("entities")),
        "holding",
    )
    held_terms = stored(
        rows.where(F.size("base") > 0).join(holding.select("row"), "row", "left_semi").select("row", F.explode(_terms(outside)).alias("term")),
        "held-terms",
    )
    often = held_terms.groupBy("term").agg(F.count("*").alias("n")).where(f"n >= {SUPPORT}").select("term")
    highest = entities.agg(F.max("most")).scalar()
    counted = stored(
        rows.select(_terms(outside).alias("terms"))
        .withColumn("bits", bitmap(often, "term").scalar())
        .select(F.explode(F.filter("terms", lambda x: marked(F.col("bits"), x))).alias("term"))
        .groupBy("term")
        .agg(F.count("*").alias("n_t"))
        .where((F.col("n_t") >= SUPPORT) & (F.col("n_t") <= highest)),
        "terms",
    )
    near = (
        held_terms.withColumn("bits", bitmap(counted, "term").scalar())
        .where(marked(F.col("bits"), F.col("term")))
        .select("row", "term")
        .join(counted, "term")
        .join(holding, "row")
    )
    joint = (
        near.select("term", "n_t", F.explode(F.filter("entities", lambda e: F.col("n_t") <= e["most"])).alias("e"))
        .groupBy("e.entity", "term")
        .agg(F.count("*").alias("n_te"), F.first("n_t").alias("n_t"), F.first("e.n_e").alias("n_e"))
        .where(f"n_te >= {SUPPORT}")
    )
    content = F.log(F.lit(total) / F.col("n_e"))
    shared = F.log(F.col("n_te") * F.lit(total) / (F.col("n_t") * F.col("n_e")))
    risky = stored(joint.where(shared >= SHARE * content).select("term").distinct(), "risky")

    hits = (
        rows.select("row", outside.alias("t"))
        .withColumn("bits", bitmap(risky, "term").scalar())
        .select("row", F.explode(_marked_terms(F.col("t"), F.col("bits"))).alias("n"))
        .select("row", F.lower("n.value").alias("term"), "n.start", "n.end")
        .join(risky, "term")
        .groupBy("row")
        .agg(
            F.collect_list(
                F.struct(
                    "start", F.lit(len(KINDS)).alias("kind_no"), F.lit(TERM).alias("kind"), "end", F.col("term").alias("value")
                )
            ).alias("more")
        )
    )
    whole = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return rows.select("row", "base", *names).join(hits, "row", "left").select(
        *[F.col(k).alias(c) for c, k in zip(keep, names)], "base", whole.alias("spans")
    )


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with each span generalised to its kind, ``[EMAIL]`` and so on; of overlapping spans,
    what an earlier one left."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    folded = F.aggregate(
        spans,
        start,
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(
                x["end"] > s["at"],
                F.concat(
                    s["out"],
                    F.array(
                        text.substr(s["at"] + 1, F.greatest(x["start"] - s["at"], F.lit(0))),
                        F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")),
                    ),
                ),
            )
            .otherwise(s["out"])
            .alias("out"),
        ),
    )
    rest = lambda f: F.concat(F.array_join(f["out"], ""), text.substr(f["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, rest(folded)).otherwise(text)
