"""Personal data: fixed patterns, and bootstrapped contextual extraction of what they miss.

The four fixed patterns (e-mail, IP, card, phone) give the base spans; these are the seed entities.  Every word with a
digit or an at sign, without the punctuation at its edges, is an occurrence: an instance (its text) in up to six patterns
(the one to three words before it or after it, and its coarse type).  Pieces side by side ("555 0100") share the words
around all of them.  Patterns and instances form a graph, scored in rounds:

* a pattern's known instances are those that a base span overlaps there and the distinctive ones (an at sign, or five
  digits or more) that are known from anywhere; others of the same type are against it;
* a pattern is trusted when it has at least ``min_known`` known instances and their share is at least ``min_share``;
* a distinctive instance becomes known when a trusted pattern holds it.

After the last round every occurrence in a trusted pattern, and of a known distinctive instance, that overlaps no base
span is a discovered span, kind ``context``.  Everything runs as DataFrame operations.  Words without a digit or at sign
("name at host") are never occurrences.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlens.functions.columns import with_computed
from reviewlens.session import stage

from .common import numbered, renamed, text_key, text_or_empty

# The contract's patterns, written so that Java matches them in linear time: possessive repeats where giving back
# cannot help, and no start inside a run whose first character failed already (\G: after a match one may).
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])[0-9]++(?:[\x20-][0-9]++)*+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "context")
#: A word with a digit or an at sign, without the white space around it.
OCCURRENCE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

#: Punctuation that is no part of an instance at its edges.
EDGES = ".,;:!?()[]{}<>\"'`"
#: Words before or after an instance that are a pattern, at least and at most.  One word alone is no evidence; one on each side is.
LEAST, CONTEXT = 2, 3
#: Patterns trusted from the start: a name for a secret right before the instance (behind it "=" or ":"), or a name for a
#: number before one of many digits.
FRAMES = (r"^[19]<= (token|password|passwd|secret|api_key|apikey|access_key|auth)( |$)"
          r"|^9<(token|password|passwd|secret|api_key|apikey|access_key|ssn|passport|iban) ")
#: Instances with so many digits, or an at sign, mean the same wherever they are.
DISTINCT_DIGITS = 5

ROUNDS = 3
MIN_KNOWN = 3
MIN_SHARE = 0.8

_SPANS = "array<struct<start:bigint,end:bigint,value:string>>"
_WORD = "struct<gap:bigint,value:string,before:array<string>,after:array<string>>"


def matches(text: Column, pattern: str, valid) -> Column:
    """Valid leftmost non-overlapping matches as (start, end, value); positions in code points.

    The pieces between matches (``split``) and the matches, zipped, add up to the text, so their lengths give places.
    Only valid matches are gathered.
    """
    zipped = F.zip_with(F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                        lambda gap, m: F.struct(F.length(gap).cast("bigint").alias("gap"), m.alias("m")))

    def step(s, x):
        start = s["pos"] + x["gap"]
        end = start + F.coalesce(F.length(x["m"]), F.lit(0)).cast("bigint")
        span = F.array(F.struct(start.alias("start"), end.alias("end"), x["m"].alias("value")))
        return F.struct(end.alias("pos"),
                        F.when(x["m"].isNotNull() & valid(x["m"]), F.concat(s["out"], span)).otherwise(s["out"]).alias("out"))

    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.array().cast(_SPANS).alias("out"))
    return F.aggregate(zipped, zero, step, lambda s: s["out"])


def valid_ip(m: Column) -> Column:
    def small(part):
        bare = F.ltrim(part, F.lit("0"))
        return (F.length(bare) < 3) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(m, r"\."), small)


def valid_card(m: Column) -> Column:
    digits = F.reverse(F.regexp_replace(m, "[^0-9]", ""))
    n = F.length(digits)

    def luhn(s, i):
        d = F.substr(digits, i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return s + F.when(i % 2 == 0, doubled).otherwise(d)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), F.lit(0), luhn)
    return F.when(n.between(13, 19), total % 10 == 0).otherwise(F.lit(False))


def valid_phone(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)


def always(m: Column) -> Column:
    return F.lit(True)


def base_spans(df: DataFrame) -> DataFrame:
    """Add ``email, ip, card, phone`` (arrays of spans) for the non-null column ``text``.

    Texts without the character that a pattern needs skip it.
    """
    digit, none = F.col("text").rlike("[0-9]"), F.array().cast(_SPANS)
    when = lambda cond, pattern, valid: F.when(cond, matches(F.col("text"), pattern, valid)).otherwise(none)
    return with_computed(df, email=when(F.contains("text", F.lit("@")), EMAIL, always),
                         ip=when(digit & F.contains("text", F.lit(".")), IP, valid_ip),
                         card=when(digit, CARD, valid_card),
                         phone=when(F.contains("text", F.lit("+")), PHONE, valid_phone))


def context_words(gap: Column, last: bool) -> Column:
    """Up to ``CONTEXT`` words at the end (or start) of ``gap``, the nearest first; null if it is white space alone."""
    near = F.substring_index(F.trim(F.regexp_replace(gap, " +", " ")), " ", -CONTEXT if last else CONTEXT)
    words = F.filter(F.transform(F.split(F.lower(near), " "), lambda w: F.btrim(w, F.lit(EDGES))), lambda w: w != "")
    return F.when(F.size(words) > 0, F.reverse(words) if last else words)


def occurrences(text: Column) -> Column:
    """Every word with a digit or at sign, in turn: (characters between it and the one before, value, words before and after)."""
    flat = F.translate(text, "\t\n\x0b\x0c\r", "     ")
    gaps = F.transform(F.split(flat, OCCURRENCE, -1), lambda g: F.struct(
        F.length(g).cast("bigint").alias("gap"), context_words(g, True).alias("before"), context_words(g, False).alias("after")))
    zipped = F.zip_with(
        F.arrays_zip(gaps.alias("g"), F.slice(gaps, 2, F.length(text) + 1).alias("next")),
        F.regexp_extract_all(flat, F.lit(OCCURRENCE), F.lit(0)),
        lambda x, m: F.struct(x["g"]["gap"].alias("gap"), m.alias("value"), x["g"]["before"].alias("before"),
                              x["next"]["after"].alias("after")))
    return F.filter(zipped, lambda x: x["value"].isNotNull())


def with_seeds(d: DataFrame) -> DataFrame:
    """Occurrences by row, with ``seed``: whether a base span overlaps them.

    Spans and occurrences of a text meet in the order of their places: an occurrence overlaps a span that starts before
    its end if the furthest end of those so far is behind its start.
    """
    one = d.where(F.size("occ") > 0).dropDuplicates(["doc_id", "h"])
    none = F.lit(None).cast("bigint")
    in_turn = Window.partitionBy("doc_id", "h").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    back = Window.partitionBy("doc_id", "h").orderBy(F.desc("i")).rowsBetween(Window.unboundedPreceding, 0)
    run = Window.partitionBy("doc_id", "h", "run")
    # Lead and trail: punctuation at the edges.  Pieces side by side take the words before the first and after the last, and
    # are one instance: a number written in four pieces counts once.
    lead = F.length("o.value") - F.length(F.ltrim("o.value", F.lit(EDGES)))
    bare = F.btrim("o.value", F.lit(EDGES))
    words = one.select("doc_id", "h", F.posexplode("occ").alias("i", "o")).withColumns({
        "stop": F.sum(F.col("o.gap") + F.length("o.value")).over(in_turn),
        "before": F.last("o.before", ignorenulls=True).over(in_turn), "run": F.count("o.before").over(in_turn),
        "after": F.last("o.after", ignorenulls=True).over(back)})
    words = words.withColumns({
        "start": F.col("stop") - F.length("o.value") + lead,
        "at_sign": F.max(F.contains("o.value", F.lit("@"))).over(run), "pieces": F.count(F.lit(1)).over(run),
        "digits": F.sum(n_digits(F.col("o.value"))).over(run), "turn": F.col("i") - F.min("i").over(run)})
    whole = F.hex(F.bit_xor(F.xxhash64(bare, "turn")).over(run))
    words = words.withColumn("instance", F.when(F.col("pieces") == 1, bare).otherwise(F.concat_ws(" ", "pieces", whole))).select(
        "doc_id", "h", "start", (F.col("start") + F.length(bare)).alias("end"), bare.alias("value"), "instance",
        (F.col("at_sign") | (F.col("digits") >= DISTINCT_DIGITS)).alias("distinct"), "before", "after", "digits",
        (F.col("start") + F.length(bare)).alias("at"), F.lit(0).alias("kind"), none.alias("reach"))
    spans = one.select("doc_id", "h", F.inline(F.concat("email", "ip", "card", "phone"))).select(
        "*", F.lit(None).cast("array<string>").alias("before"), F.lit(None).cast("array<string>").alias("after"),
        none.alias("digits"), F.lit(None).cast("string").alias("instance"), F.lit(None).cast("boolean").alias("distinct"), F.col("start").alias("at"), F.lit(1).alias("kind"), F.col("end").alias("reach"))
    so_far = Window.partitionBy("doc_id", "h").orderBy("at", "kind").rowsBetween(Window.unboundedPreceding, 0)
    both = words.unionByName(spans).withColumn(
        "seed", F.coalesce(F.max("reach").over(so_far) > F.col("start"), F.lit(False)))
    return both.where("kind = 0").select("doc_id", "h", "start", "end", "value", "instance", "distinct", "seed",
                                         patterns(F.col("value"), F.col("digits"), F.col("before"), F.col("after")).alias("patterns"))


def n_digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def patterns(value: Column, digits: Column, before: Column, after: Column) -> Column:
    """Coarse type (at sign, many digits, few; ``digits`` are those of all pieces side by side), side and words of each pattern."""
    kind = F.when(F.contains(value, F.lit("@")), "@").when(digits >= DISTINCT_DIGITS, "9").otherwise("1")
    one = [F.when(F.size(side) >= n, F.concat(kind, F.lit(mark), F.array_join(F.slice(side, 1, n), " ")))
           for mark, side in (("<", before), (">", after)) for n in range(LEAST, CONTEXT + 1)]
    one.append(F.when((F.size(before) > 0) & (F.size(after) > 0), F.concat(
        kind, F.lit("<"), F.element_at(before, 1), F.lit(" > "), F.element_at(after, 1))))
    return F.array_compact(F.array(*one))


def bootstrap(occ: DataFrame, rounds: int = ROUNDS, min_known: int = MIN_KNOWN, min_share: float = MIN_SHARE):
    """(trusted patterns, distinctive instances that they hold and no seed names): columns ``pattern`` and ``instance``.

    ``occ`` has one row an occurrence: ``patterns, instance, distinct`` (whether the instance means the same wherever it
    is), ``seed`` (true where a base span overlaps it).  The graph's edges are distinct (pattern, instance) pairs, so copies
    of a text count once and a frequent pair or pattern is aggregated before it is shuffled.  ``FRAMES`` are trusted as they are.
    """
    edges = occ.select(F.explode("patterns").alias("pattern"), "instance", "distinct", "seed")
    edges = stage(edges.groupBy("pattern", "instance").agg(F.max("distinct").alias("distinct"), F.max("seed").alias("seed")), "edges")
    seeds = occ.where(F.col("seed") & F.col("distinct")).select("instance").distinct()
    seeds = known = stage(seeds.withColumn("known", F.lit(True)), "seeds")
    trusted = edges.select("pattern").limit(0)
    for _ in range(rounds):
        scored = edges.join(known, "instance", "left").groupBy("pattern").agg(
            F.count(F.lit(1)).alias("n"), F.count_if(F.col("seed") | F.col("known").isNotNull()).alias("n_known"))
        good = (F.col("n_known") >= min_known) & (F.col("n_known") >= min_share * F.col("n"))
        trusted = stage(scored.where(good | F.col("pattern").rlike(FRAMES)).select("pattern"), "trusted")
        held = edges.where("distinct").join(trusted, "pattern").select("instance")
        known = stage(seeds.select("instance").union(held).distinct().withColumn("known", F.lit(True)), "known")
    return trusted, known.join(seeds.select("instance"), "instance", "left_anti").select("instance")


def find(df: DataFrame, **limits) -> DataFrame:
    """``doc_id, h, email, ip, card, phone, context`` (arrays of spans) by row of ``df`` (columns doc_id, text).

    ``h`` is the text's hash; rows that repeat doc_id and text get equal results.  Null text is empty and has no spans;
    a null doc_id is kept.  A text is scanned whole.
    """
    docs = base_spans(df.select("doc_id", text_or_empty().alias("text")))
    seen = F.when(F.col("text").rlike("[0-9@]"), occurrences(F.col("text")))
    d = with_computed(docs, h=text_key(), occ=F.coalesce(seen, F.array().cast(f"array<{_WORD}>")))
    # No text is written: only spans and the few words that look like identifiers.
    base = stage(d.select("doc_id", "h", "email", "ip", "card", "phone", "occ"), "pii")
    occ = stage(with_seeds(base), "occurrences")
    base = base.drop("occ")
    trusted, new = bootstrap(occ, **limits)
    rest, place = occ.where("not seed"), ["doc_id", "h", "start", "end", "value"]
    held = rest.select(*place, F.explode("patterns").alias("pattern")).join(trusted, "pattern").select(*place)
    found = (held.union(rest.join(new, "instance").select(*place)).groupBy("doc_id", "h")
             .agg(F.array_sort(F.collect_set(F.struct("start", "end", "value"))).cast(_SPANS).alias("context")))
    f = found.withColumnsRenamed({"doc_id": "fd", "h": "fh"})
    out = base.join(f, F.col("doc_id").eqNullSafe(F.col("fd")) & (F.col("h") == F.col("fh")), "left")
    return out.select("doc_id", "h", "email", "ip", "card", "phone",
                      F.coalesce("context", F.array().cast(_SPANS)).alias("context"))


def span_string(*kinds: str) -> Column:
    """kind:start:end of every span, by kind as listed and then start, comma-joined."""
    parts = [F.transform(k, lambda s: F.concat_ws(":", F.lit(k), s["start"], s["end"])) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def redact(df: DataFrame, **limits) -> DataFrame:
    """``df`` with every span of its column ``text`` put out: ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]``, ``[CONTEXT]``.

    Overlapping spans give way to the one that starts first (then the kind listed first).  Null texts stay null,
    ``n_chars`` is counted anew where the text changed, all other columns and rows stay.
    """
    marked = [F.transform(k, lambda s: F.struct(s["start"].alias("start"), F.lit(i).alias("rank"), s["end"].alias("end"),
                                                F.lit(f"[{k.upper()}]").alias("mark"))) for i, k in enumerate(KINDS)]
    spans = (find(df, **limits).select(F.col("doc_id").alias("_d"), "h", F.array_sort(F.concat(*marked)).alias("_spans"))
             .where(F.size("_spans") > 0).dropDuplicates(["_d", "h"]))
    rows = df.select(*numbered(df, "text"), df["doc_id"].alias("_id"), text_key().alias("_key"), df["text"].alias("_t"))
    d = rows.join(spans, F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_key") == F.col("h")), "left")

    def step(s, x):
        piece = F.substring(F.col("_t"), (s["pos"] + 1).cast("int"), (x["start"] - s["pos"]).cast("int"))
        return F.when(x["start"] >= s["pos"], F.struct(x["end"].alias("pos"), F.concat(s["out"], piece, x["mark"]).alias("out"))
                      ).otherwise(s)

    zero = F.struct(F.lit(0).cast("bigint").alias("pos"), F.lit("").alias("out"))
    cut = F.aggregate("_spans", zero, step, lambda s: F.concat(
        s["out"], F.substring(F.col("_t"), (s["pos"] + 1).cast("int"), F.length("_t"))))
    changed = F.col("_spans").isNotNull()
    d = with_computed(d, _text=F.when(changed, cut).otherwise(F.col("_t")))
    new = {"text": F.col("_text")}
    if "n_chars" in df.columns:
        new["n_chars"] = F.when(changed, F.length("_text").cast("bigint")).otherwise(F.col(f"_c{df.columns.index('n_chars')}"))
    return d.select(*renamed(df.columns, **new))


def op7_personal_data(spark, sf_dir: str) -> DataFrame:
    from .common import table

    d = find(table(spark, sf_dir, "documents"))
    base = KINDS[:4]
    return d.select("doc_id", *[F.size(k).cast("bigint").alias(f"n_{k}") for k in base],
                    F.sha2(span_string(*base).cast("binary"), 256).alias("base_sha256"),
                    span_string(*KINDS).alias("spans"))
