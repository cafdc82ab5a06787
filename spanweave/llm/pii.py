"""Personal data by bootstrapped contextual extraction.

Entities with a fixed form are the seeds: four kinds of personal data, and keys
of many hexadecimal digits. The words and signs around them are lexical
patterns; patterns and the identifier-like tokens that stand in them form a
graph, whose scores Spark refines until no pattern or token is new: a pattern
is trusted by the share of its tokens that are entities or believed, a token
believed by the patterns it stands in. Tokens that trusted patterns vouch for
are identifiers of a form not seen before and are reported as kind ``id``.

DataFrame functions only. A match's place comes from splitting the text at the
same expression: pieces and matches alternate, so their lengths add up to it.
Running sums over a text's matches go chunk by chunk, in time proportional to
their number for all but endless texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanweave.llm.common import table, text_or_empty
from spanweave.scratch import Scratch

#: In the order in which spans of one place are listed
KINDS = ("email", "ip", "card", "phone", "key", "id")
#: Kinds that counts and digest concern
BASE = KINDS[:4]
# The forms of the seeds. Lookbehinds and possessive repeats change no match; they keep long texts linear.
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # not of the base: 32 hexadecimal digits or more, of both sorts
    "key": r"(?<![0-9A-Za-z])(?=[0-9]*+[A-Fa-f])(?=[A-Fa-f]*+[0-9])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])",
}
BYTE = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Identifier-like: 4 to 256 signs of words, addresses and base64 with a digit early on
CANDIDATE = r"(?<![0-9A-Za-z_.@+/=-])(?=[A-Za-z_.@+/=-]{0,64}[0-9])[0-9A-Za-z_.@+/=-]{3,255}[0-9A-Za-z=](?![0-9A-Za-z_@+/=-])"
# What counts as a word and as signs between words in a pattern.
WORD, SIGNS = r"[\p{L}\p{N}_]+", r"[^\p{L}\p{N}_\n]{1,8}"
#: The patterns of a place: one word and two before it, at the start of a line too, and one after it
LEFT, LEFT2, RIGHT = rf"((?:^|\n|(?<![\p{{L}}\p{{N}}_])){WORD}{SIGNS})$", rf"({WORD}{SIGNS}{WORD}{SIGNS})$", rf"^({SIGNS}{WORD})"
#: Characters of context, different seeds or believed tokens that a pattern needs, trust in a pattern and belief in a token from which they count, and the step of belief that ends the rounds
CONTEXT, SUPPORT, TRUST, BELIEF, STILL = 80, 3, 0.6, 0.85, 1e-4
#: Matches in a chunk of a running sum
CHUNK = 256


def luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    n = F.length(digits)

    def step(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step) % 10 == 0


def holds(kind: str, match: Column) -> Column:
    """Whether a match of the kind's form is an entity."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{BYTE}(?:\.{BYTE}){{3}}$")
    if kind == "card":
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


ENTITY = "array<struct<start:long,place:int,end:long,token:string,around:array<string>>>"


def running(items: Column, zero: Column, merge) -> Column:
    """The state before each item, where merge(state, item) is the state after it; whole numbers."""
    none, many = F.array().cast("array<long>"), F.array().cast("array<array<long>>")
    chunk = F.greatest(F.lit(CHUNK), F.ceil(F.sqrt(F.size(items))).cast("int"))
    begins = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), chunk)
    chunks = F.transform(begins, lambda b: F.slice(items, b, chunk))

    def within(state, chunk):
        return F.aggregate(chunk, F.struct(state.alias("at"), none.alias("out")), lambda t, x: F.struct(merge(t["at"], x).alias("at"), F.concat(t["out"], F.array(t["at"])).alias("out")), lambda t: t["out"])

    def step(s, chunk):
        return F.struct(F.aggregate(chunk, s["at"], merge).alias("at"), F.concat(s["out"], F.array(within(s["at"], chunk))).alias("out"))

    states = F.aggregate(chunks, F.struct(zero.cast("long").alias("at"), many.alias("out")), step, lambda s: F.flatten(s["out"]))
    return F.when(F.size(items) == 0, none).otherwise(states)


def entities(cut: Column, place: int, fine) -> Column:
    """Entities of cuts (z: match, before and after it; start) that fine accepts, with the patterns around them."""

    def entity(x):
        z, start = x["z"], x["start"]
        before, after = F.substring(z["before"], -CONTEXT, CONTEXT), F.substring(z["after"], 1, CONTEXT)
        around = [F.concat(F.lit(name), F.lower(F.nullif(F.regexp_extract(side, form, 1), F.lit("")))) for name, side, form in (("1 ", before, LEFT), ("2 ", before, LEFT2), ("r ", after, RIGHT))]
        return F.struct(start.alias("start"), F.lit(place).alias("place"), (start + F.length(z["match"])).alias("end"), z["match"].alias("token"), F.filter(F.array(*around), lambda p: p.isNotNull()).alias("around"))

    return F.transform(F.filter(cut, lambda x: fine(x["z"]["match"])), entity).cast(ENTITY)


def found_in(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, base, more) of each row: entities, and candidates that don't overlap any."""
    texts = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    digit = F.col("text").rlike("[0-9]")
    quick = {"email": F.col("text").contains("@"), "ip": digit, "card": digit, "phone": F.col("text").contains("+"), "key": digit, "any": digit}
    none = F.array().cast("array<string>")
    forms = FORMS | {"any": CANDIDATE}
    # Columns of their own, so that a match isn't sought again for each step over the matches. A lambda reads nothing but
    # its arguments: a column in it would be worked out anew for each item.
    cut = texts.withColumns({f"m_{k}": F.when(quick[k], F.regexp_extract_all("text", F.lit(form), F.lit(0))).otherwise(none) for k, form in forms.items()})
    cut = cut.withColumns({f"p_{k}": F.when(F.size(f"m_{k}") > 0, F.split("text", form, -1)).otherwise(none) for k, form in forms.items()})
    n = lambda k: F.size(f"m_{k}")
    cut = cut.withColumns({f"z_{k}": F.arrays_zip(F.col(f"m_{k}").alias("match"), F.slice(f"p_{k}", 1, n(k)).alias("before"), F.slice(f"p_{k}", 2, n(k)).alias("after")) for k in forms})
    cut = cut.withColumns({f"s_{k}": running(F.col(f"z_{k}"), F.lit(0), lambda at, z: at + F.length(z["before"]) + F.length(z["match"])) for k in forms})
    starts = lambda k: F.zip_with(f"s_{k}", f"z_{k}", lambda at, z: F.struct(z.alias("z"), (at + F.length(z["before"])).alias("start")))
    texts = cut.withColumns({k: entities(starts(k), KINDS.index(k) if k in FORMS else KINDS.index("id"), lambda m, k=k: holds(k, m)) for k in forms})
    # in one sorted list a candidate overlaps an entity before it that ends after its start, or the next entity if that starts before its end
    is_base = lambda e: e["place"] < KINDS.index("id")
    texts = texts.withColumns({"base": F.array_sort(F.concat(*FORMS)), "all": F.array_sort(F.concat(*FORMS, "any"))})
    far = 1 << 60
    texts = texts.withColumns(
        {
            "reach": running(F.col("all"), F.lit(-1), lambda at, e: F.greatest(at, F.when(is_base(e), e["end"]).otherwise(at))),
            "next": F.reverse(running(F.reverse("all"), F.lit(far), lambda at, e: F.least(at, F.when(is_base(e), e["start"]).otherwise(at)))),
        }
    )
    clear = F.filter(F.arrays_zip("all", "reach", "next"), lambda x: ~is_base(x["all"]) & (x["reach"] <= x["all"]["start"]) & (x["next"] >= x["all"]["end"]))
    clear = F.transform(clear, lambda x: x["all"])
    return texts.select("id", F.xxhash64("text").alias("h"), "base", clear.alias("more"))


def discovered(found: DataFrame, scratch: Scratch) -> DataFrame:
    """(token) that trusted patterns vouch for."""
    one = lambda c, seed: found.select(F.explode(c).alias("e")).select("e.token", F.explode("e.around").alias("pattern"), F.lit(seed).alias("seed"))
    edges = scratch.save(one("base", True).unionByName(one("more", False)).groupBy("pattern", "token").agg(F.count(F.lit(1)).alias("n"), F.max("seed").alias("seed")))
    belief, last = None, None
    while True:
        known = edges.withColumn("belief", F.lit(0.0)) if belief is None else edges.join(belief.select("token", "belief"), "token", "left").withColumn("belief", F.coalesce("belief", F.lit(0.0)))
        known = known.withColumn("belief", F.when(F.col("seed"), 1.0).otherwise(F.col("belief")))
        trust = scratch.save(known.groupBy("pattern").agg((F.sum(F.col("belief") * F.col("n")) / (F.sum("n") + 1)).alias("trust"), F.count_if(F.col("belief") >= BELIEF).alias("support")).filter((F.col("support") >= SUPPORT) & (F.col("trust") >= TRUST)))
        doubt = F.sum(F.log(1 - F.least("trust", F.lit(0.99))))
        belief = scratch.save(known.filter("NOT seed").join(trust, "pattern").groupBy("token").agg((1 - F.exp(doubt)).alias("belief"), F.max("belief").alias("before")))
        grown = belief.agg(F.count(F.lit(1)).alias("tokens"), F.count_if(F.col("belief") >= BELIEF).alias("believed"), F.max(F.col("belief") - F.col("before")).alias("step")).first()
        now = (trust.count(), grown["tokens"], grown["believed"])
        # trust and belief only grow; what still creeps may yet reach a threshold
        if now == last and (grown["step"] or 0) < STILL:
            break
        last = now
    return belief.filter(F.col("belief") >= BELIEF).select("token")


def listed(spans: Column) -> Column:
    """kind:start:end of each, by start and then in the order of kinds."""
    names = F.array(*map(F.lit, KINDS))
    ordered = F.array_sort(spans)
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["place"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_more, n_spans for every row of docs.

    Counts and digest concern the base entities; spans also lists keys and the
    identifiers that contexts discover (n_more of them, n_spans with the base).
    Null and empty texts have none; an empty table gives an empty one. Repeated
    rows get the same, as do rows with one identifier and text; whole texts of
    any length are read, in time proportional to it; other columns aren't read.
    The graph of patterns and tokens is aggregated before each join, and no
    part of it comes to the driver.
    """
    scratch = Scratch(docs.sparkSession)
    found = scratch.save(found_in(docs, id_col, text_col))
    short = lambda a: F.transform(a, lambda e: F.struct(e["start"], e["place"], e["end"]))
    tokens = discovered(found, scratch)
    hits = found.select("id", "h", F.explode("more").alias("e")).select("id", "h", "e.*").join(tokens, "token").groupBy("id", "h").agg(F.collect_set(F.struct("start", "place", "end")).alias("extra"))
    same = F.col("f.id").eqNullSafe(F.col("x.id")) & (F.col("f.h") == F.col("x.h"))
    joined = found.alias("f").join(hits.alias("x"), same, "left")
    seeds, extra = short(F.col("f.base")), F.coalesce(F.col("x.extra"), F.array().cast("array<struct<start:long,place:int,end:long>>"))
    base = F.filter(seeds, lambda e: e["place"] < len(BASE))
    places = F.transform(seeds, lambda e: e["place"])
    counts = [(F.size(seeds) - F.size(F.array_remove(places, KINDS.index(k)))).cast("long").alias(f"n_{k}") for k in BASE]
    n_spans = (F.size(seeds) + F.size(extra)).cast("long")
    return joined.select(F.col("f.id").alias(id_col), *counts, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.concat(seeds, extra)).alias("spans"), (n_spans - F.size(base)).alias("n_more"), n_spans.alias("n_spans"))


def op2(spark, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))
