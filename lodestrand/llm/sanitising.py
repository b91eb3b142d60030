"""Personal data in texts, and the terms that give it away.

Base spans are found by pattern: e-mail addresses, IP addresses, card numbers
(Luhn) and phone numbers.  Each value found is a protected entity.  Over the
whole corpus, co-occurrence then tells what else reveals an entity: a term (a
word of at least MIN_LETTERS letters outside of addresses) is counted with an
entity where it stands among the NEAR words on either side, and

    disclosure = PMI(entity; term) / IC(entity)
               = log(n(e, t) N / (n(e) n(t))) / log(N / n(e))

is 1 where a document with the term always has the entity beside it, 0 where
the term says nothing of it.  A pair counts only if it was seen in MIN_CONTEXTS
different surroundings, so that exact copies of a passage are one observation.
In a document that holds the entity, a term whose disclosure reaches GENERALISE
is generalised (a sign of its kind takes its place), from REMOVE on it is
removed.  Documents without an entity stay as they are.

All of it is DataFrame functions.  Where a match starts is a running sum over
lengths of gaps and matches, taken in log2(n) rounds of a higher-order function
(n log n, no list is copied once an element).  Patterns do not go back over what
they have read, so a word or number of a megabyte takes linear time.  Arrays are
unfolded with explode_outer: explode would have its array made twice, once for
a filter by its size that is pushed below the steps it is made in.  Texts with
an entity are written once; only entities, pairs and narrow rows are shuffled,
counts summed up before.  Terms are counted in all documents, by task before
they are shuffled.

Defined results: null texts are empty; repeated rows are documents of their own
and each counts; entities are compared by lower-cased address, or digits; an entity that
all documents hold tells nothing (IC 0) and has no terms; a surroundings ends
at the next match of the same kind, and a word cut by its border is left out; an
empty table gives no rows; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import save, settle

KINDS = ("email", "ip", "card", "phone", "term")
MIN_LETTERS, NEAR, NEAR_CHARS, MIN_CONTEXTS, GENERALISE, REMOVE = 3, 8, 120, 3, 0.9, 0.98
#: Disclosing terms, and hits, of so many rows are sent to every executor; more meet the other side by key.
BROADCAST_ROWS = 200_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = r"\x20\x09-\x0D"
# Possessive; an address starts where the one before it ends (\G) or where no sign of a name stands before it.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
PATTERNS = (
    EMAIL,
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # whole runs of digits with single separators that hold 12 to 19 digits
    r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WORD = r"[^\x00-\x60\x7B-\x7F]+"
_PART = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
IP_PARTS = rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$"


def running(values: Column, merge=lambda a, b: a + b) -> Column:
    """Of an array, what merging all elements up to each gives, in log2(n) rounds."""
    rounds = F.when(F.size(values) > 1, F.sequence(F.lit(0), F.ceil(F.log2(F.size(values))).cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    steps = F.transform(rounds, lambda k: F.pow(F.lit(2.0), k).cast("int"))
    return F.aggregate(steps, values, lambda acc, n: F.transform(acc, lambda x, i: F.when(i >= n, merge(F.get(acc, i - n), x)).otherwise(x)))


def _lowered(text: Column) -> Column:
    return F.translate(text, _UPPER, _LOWER)


def _located(df: DataFrame, text: str, patterns: dict[str, str], given: dict[str, Column] | None = None) -> DataFrame:
    """df with an array of (start, end, value, left, right) of the matches of each pattern; left and right are the texts up to the matches before and behind. In steps, since a plan repeats what one expression uses twice."""
    found = {f"_m_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(0)) for k, p in patterns.items()}
    df = df.withColumns({k: F.when(given[k.removeprefix("_m_")], v).otherwise(F.array().cast("array<string>")) if given else v for k, v in found.items()})
    df = df.withColumns({f"_g_{k}": F.when(F.size(f"_m_{k}") > 0, F.split(text, p, -1)).otherwise(F.array().cast("array<string>")) for k, p in patterns.items()})
    lengths = {k: F.transform(F.col(f"_m_{k}"), lambda m, i: F.length(F.get(f"_g_{k}", i)) + F.length(m)) for k in patterns}
    df = df.withColumns({f"_e_{k}": lengths[k] for k in patterns})
    df = df.withColumns({f"_e_{k}": running(F.col(f"_e_{k}")) for k in patterns})

    def spans(k: str) -> Column:
        return F.transform(
            f"_m_{k}",
            lambda m, i: F.struct(
                (F.get(f"_e_{k}", i) - F.length(m)).alias("start"), F.get(f"_e_{k}", i).alias("end"), m.alias("value"), F.get(f"_g_{k}", i).alias("left"), F.get(f"_g_{k}", i + 1).alias("right")
            ),
        )

    return df.withColumns({k: spans(k) for k in patterns}).drop(*[f"_{x}_{k}" for k in patterns for x in "mge"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right is doubled, and its digits summed."""
    places = F.sequence(F.lit(1), F.length(digits))
    backwards = F.reverse(digits)
    total = F.aggregate(places, F.lit(0), lambda acc, i: acc + F.substring(F.when(i % 2 == 0, F.translate(backwards, "0123456789", "0246813579")).otherwise(backwards), i, F.lit(1)).cast("int"))
    return total % 10 == 0


def _holds(kind: int, value: Column) -> Column:
    if kind == 1:
        return value.rlike(IP_PARTS)
    if kind == 2:
        return _luhn(_digits(value))
    return F.length(_digits(value)).between(9, 15) if kind == 3 else F.lit(True)


def _words(text: Column) -> Column:
    return F.filter(F.regexp_extract_all(_lowered(text), F.lit(WORD), F.lit(0)), lambda w: F.length(w) >= MIN_LETTERS)


def _near(span: Column) -> Column:
    """The NEAR words on either side of a span, as far as NEAR_CHARS characters."""

    def words(part: Column) -> Column:
        return _words(F.regexp_replace(part, EMAIL, " "))

    left, right = span["left"], span["right"]
    before = words(F.when(F.length(left) > NEAR_CHARS, F.regexp_replace(F.right(left, F.lit(NEAR_CHARS)), f"^[^{_BLANK}]*", "")).otherwise(left))
    behind = words(F.when(F.length(right) > NEAR_CHARS, F.regexp_replace(F.left(right, F.lit(NEAR_CHARS)), rf"[^{_BLANK}]*\z", "")).otherwise(right))
    return F.concat(F.slice(F.reverse(before), 1, NEAR), F.slice(behind, 1, NEAR))


def base_spans(docs: DataFrame) -> DataFrame:
    """doc_id, text (null unless it holds an entity), n_email, n_ip, n_card, n_phone, spans (start, kind, end; sorted) and entities (kind, value, words near it) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"))
    given = {"email": F.contains("_text", F.lit("@")), "ip": F.contains("_text", F.lit(".")), "card": F.lit(True), "phone": F.contains("_text", F.lit("+"))}
    rows = _located(rows, "_text", dict(zip(KINDS, PATTERNS)), given)
    rows = rows.withColumns({k: F.filter(k, lambda s: _holds(n, s["value"])) for n, k in enumerate(KINDS[:4])})
    spans = F.concat(*[F.transform(k, lambda s: F.struct(s["start"].alias("start"), F.lit(n).alias("kind"), s["end"].alias("end"))) for n, k in enumerate(KINDS[:4])])
    entities = F.concat(
        *[
            F.transform(k, lambda s: F.struct(F.lit(n).alias("kind"), (_lowered(s["value"]) if n == 0 else s["value"] if n == 1 else _digits(s["value"])).alias("value"), _near(s).alias("words")))
            for n, k in enumerate(KINDS[:4])
        ]
    )
    return rows.select("doc_id", F.when(F.size(spans) > 0, F.col("_text")).alias("text"), *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:4]], F.array_sort(spans).alias("spans"), entities.alias("entities"))


def _pairs(found: DataFrame) -> DataFrame:
    """rid, kind, value, term and context (a digest of the other words near it): each entity and term of a document once."""
    listed = F.flatten(
        F.transform(
            "entities",
            lambda e: F.transform(F.array_distinct(e["words"]), lambda t: F.struct(e["kind"].alias("kind"), e["value"].alias("value"), t.alias("term"), F.md5(F.array_join(F.array_remove(e["words"], t), " ").cast("binary")).alias("context"))),
        )
    )
    rows = found.where(F.size("entities") > 0).select("rid", F.array_sort(F.array_distinct(listed)).alias("_p"))

    def again(x: Column, i: Column) -> Column:
        before = F.get("_p", i - 1)
        return (i > 0) & (before["kind"] == x["kind"]) & (before["value"] == x["value"]) & (before["term"] == x["term"])

    return rows.select("rid", F.explode_outer(F.filter("_p", lambda x, i: ~F.coalesce(again(x, i), F.lit(False)))).alias("_x")).where("_x is not null").select("rid", "_x.*")


def _broadcast_if_small(df: DataFrame) -> tuple[DataFrame, bool]:
    small = df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return (F.broadcast(df) if small else df), small


def _document_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """term, n_term: of the given different terms, in how many documents each stands outside of addresses. Words are counted before they meet the terms, so a frequent one is a row a task."""
    text = F.coalesce(F.col("text"), F.lit(""))
    outside = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, " ")).otherwise(text)
    listed = docs.select(F.explode_outer(F.array_distinct(_words(outside))).alias("term")).where("term is not null")
    # a semi join would be pushed below the aggregation again, to every single word
    return listed.groupBy("term").agg(F.count("*").alias("n_term")).join(terms, "term")


def disclosing(docs: DataFrame, found: DataFrame, min_contexts: int = MIN_CONTEXTS, generalise: float = GENERALISE) -> DataFrame:
    """kind, value, term, disclosure: the terms that reveal an entity, and how strongly."""
    together = _pairs(found).groupBy("kind", "value", "term", "context").agg(F.count("*").alias("n"))
    together = save(together.groupBy("kind", "value", "term").agg(F.sum("n").alias("n_both"), F.count("*").alias("contexts")).where(F.col("contexts") >= min_contexts), "pairs")
    held = found.where(F.size("entities") > 0).select(F.explode(F.array_distinct(F.transform("entities", lambda e: F.struct(e["kind"].alias("kind"), e["value"].alias("value"))))).alias("_e"))
    held = held.select("_e.*").groupBy("kind", "value").agg(F.count("*").alias("n_entity"))
    total = found.agg(F.count("*").alias("n_all"))
    counted = together.join(held, ["kind", "value"]).join(_document_counts(docs, together.select("term").distinct()), "term").join(F.broadcast(total))
    said = F.log(F.col("n_both").cast("double") * F.col("n_all") / (F.col("n_entity").cast("double") * F.col("n_term"))) / F.log(F.col("n_all").cast("double") / F.col("n_entity"))
    counted = counted.where("n_entity < n_all").withColumn("disclosure", F.round(said, 9))
    return counted.where(F.col("disclosure") >= generalise).select("kind", "value", "term", "disclosure")


def _found(docs: DataFrame) -> DataFrame:
    return save(base_spans(docs).withColumn("rid", F.monotonically_increasing_id()), "found")


def _term_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """rid, terms: (start, kind, end, removed) of the terms to take out of each document that has any."""
    told = save(disclosing(docs, found), "disclosing")
    told, _ = _broadcast_if_small(told)
    hits = save(_pairs(found).join(told, ["kind", "value", "term"]).groupBy("rid", "term").agg(F.max("disclosure").alias("disclosure")), "hits")
    small, _ = _broadcast_if_small(hits)
    rids, _ = _broadcast_if_small(hits.select("rid").distinct())
    texts = found.select("rid", _lowered(F.col("text")).alias("_text")).join(rids, "rid", "left_semi")
    tokens = _located(texts, "_text", {"tokens": f"{EMAIL}|{WORD}"})
    tokens = tokens.select("rid", F.explode_outer("tokens").alias("_t")).where("_t is not null").select("rid", F.col("_t.start").alias("start"), F.col("_t.end").alias("end"), F.col("_t.value").alias("term"))
    marked = tokens.join(small, ["rid", "term"])
    # of one document, its own words only
    return marked.groupBy("rid").agg(F.collect_list(F.struct("start", F.lit(4).alias("kind"), "end", (F.col("disclosure") >= REMOVE).alias("removed"))).alias("terms"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256 and spans of every document; what was written on the way is deleted."""
    return settle(lambda: _all_spans(docs), "spans")


def _all_spans(docs: DataFrame) -> DataFrame:
    found = _found(docs)
    rows = found.select("rid", "doc_id", *[f"n_{k}" for k in KINDS[:4]], "spans").join(_term_spans(docs, found), "rid", "left")
    none = F.coalesce(F.col("terms"), F.array().cast("array<struct<start:int,kind:int,end:int,removed:boolean>>"))
    every = F.array_sort(F.concat("spans", F.transform(none, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))))
    return rows.select("doc_id", *[f"n_{k}" for k in KINDS[:4]], F.size(none).cast("long").alias("n_term"), F.sha2(_joined(F.col("spans")).cast("binary"), 256).alias("base_sha256"), _joined(every).alias("spans"))


def sanitise(docs: DataFrame) -> DataFrame:
    """doc_id and text: personal data replaced by [EMAIL], [IP], [CARD] and [PHONE], revealing terms by [TERM], or removed; what overlaps is one span, with the sign of its first."""
    found = _found(docs)
    rows = found.where("text is not null").select("rid", "text", "spans").join(_term_spans(docs, found), "rid", "left")
    terms = F.coalesce(F.col("terms"), F.array().cast("array<struct<start:int,kind:int,end:int,removed:boolean>>"))
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), F.lit(False).alias("removed")))
    rows = rows.select("rid", "text", F.array_sort(F.concat(base, terms)).alias("_s"))
    rows = rows.withColumn("_ends", running(F.transform("_s", lambda s: s["end"]), F.greatest))
    signs = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(s: Column, i: Column) -> Column:
        before = F.coalesce(F.get("_ends", i - 1), F.lit(0))
        return F.when(s["start"] >= before, F.concat(F.substring(F.col("text"), before + 1, s["start"] - before), F.when(s["removed"], "").otherwise(F.get(signs, s["kind"])))).otherwise("")

    # a text with spans has one at least, so the last end is there
    tail = F.substring(F.col("text"), F.element_at("_ends", -1) + 1, F.length("text"))
    clean = rows.select("rid", F.concat(F.array_join(F.transform("_s", piece), ""), tail).alias("_clean"))
    # documents without spans keep their text, which was not written: both tables are of the rows of one scan
    untouched = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("rid"))
    return untouched.join(clean, "rid", "left").select("doc_id", F.coalesce("_clean", "text").alias("text"))
