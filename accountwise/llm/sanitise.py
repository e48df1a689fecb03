"""Personal data: fixed rules, and terms that the corpus shows to reveal what the rules protect.

The rules find e-mail and IP addresses, card and phone numbers. What they find are the protected entities. A term is a
word of three or more letters, wherever it stands in a text. Over the N different texts of the corpus

    information of an entity   IC(e) = log2(1 / p(e)),  p(e) = df(e) / N
    disclosure by a term       PMI(e, t) = log2(P(e | t) / p(e)),  P(e | t) = (df(e, t) + S * p(e)) / (df(t) + S)

where df counts texts and S = ``SMOOTH`` texts in which the entity is as frequent as anywhere smooth the estimate, so that
a term of one text discloses less than one that goes along with the entity in many. In the texts of e, every occurrence of
a term that discloses at least the share ``REMOVE`` of IC is removed, and from ``GENERALISE`` on it is generalised to a mark;
a term that discloses two entities takes the stricter treatment. Letters within the rules' finds are not marked again.

Where the entity or the term occurs in one text alone, df(e, t) is 1 and needs no counting: the rarest entity of the text
decides. Only entities and terms of two or more texts make pairs, and of those only pairs whose counts can reach the
threshold. A text's pairs grow with its entities times its terms that remain. All of it is Spark expressions, joins and
sums; counting combines before the shuffle, so a common address or word is no hot spot.

A null text is empty. Empty texts have no span. Texts of any length are taken whole. Rows that repeat a text count once and are
all sanitised alike. Entities and terms are compared in lower case. Places are code points. An empty table gives an empty one;
the id must be a number or null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from accountwise.llm import spans
from accountwise.llm.texts import stored, text_of

#: The rules of the contract. Repetitions give nothing back and an address begins where its run does or the
#: match before ended: the matches are the same, and no run is gone through by recursion or more than once.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
KINDS = ("email", "ip", "card", "phone", "term", "term")
RULES = 4
MARKS = ("[EMAIL]", "[IP]", "[CARD]", "[PHONE]", "[TERM]", "")

GENERALISE, REMOVE, SMOOTH = 0.9, 0.95, 1.0
TERM = r"\p{L}{3,}"
#: Between a letter and another character.
EDGE = r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})"
_SPAN = "struct<start:int,kind:int,end:int>"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m["text"], "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    at = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    twice = lambda x: F.when(x["i"] % 2 == 1, x["d"] * 2 - F.when(x["d"] > 4, 9).otherwise(0)).otherwise(x["d"])
    return F.aggregate(at, F.lit(0), lambda s, x: s + F.coalesce(twice(x), F.lit(0))) % 10 == 0


def _rules(text: Column) -> dict[str, Column]:
    none = spans.none_found()
    small = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.right(p, F.lit(3)).cast("int") <= 255)
    ip = F.filter(spans.found(text, IP), lambda m: F.forall(F.split(m["text"], r"\."), small))
    card = F.filter(
        spans.found(text, CARD), lambda m: F.length(_digits(m)).between(12, 19) & _luhn(_digits(m))
    )
    phone = F.filter(spans.found(text, PHONE), lambda m: F.length(_digits(m)).between(9, 15))
    return {
        "_email": F.when(F.contains(text, F.lit("@")), spans.found(text, EMAIL)).otherwise(none),
        "_ip": F.when(text.rlike(r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]"), ip).otherwise(none),
        "_card": F.when(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), card).otherwise(none),
        "_phone": F.when(F.contains(text, F.lit("+")), phone).otherwise(none),
    }


def ruled(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with the rules' matches, _base (their spans in order) and _entities (what they are, once each)."""
    kinds = ("_email", "_ip", "_card", "_phone")
    out = docs.withColumns(_rules(text_of(text)))
    every = [spans.spans(F.col(c), k) for k, c in enumerate(kinds)]
    return out.withColumns({
        "_base": F.array_sort(F.concat(*every)),
        "_entities": F.array_distinct(F.transform(F.concat(*kinds), lambda m: F.lower(m["text"]))),
        **{f"_n{c}": F.size(c).cast("long") for c in kinds},
    }).drop(*kinds)


def terms_of(text: Column) -> Column:
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def share(both: Column, with_entity: Column, with_term: Column, total: int) -> Column:
    """The share of the entity's information that the term discloses; null for an entity of every text."""
    p = with_entity / F.lit(float(total))
    given = (both + SMOOTH * p) / (with_term + SMOOTH)
    return F.when(p < 1, F.log2(given / p) / F.log2(1 / p))


def disclosing(found: DataFrame) -> DataFrame:
    """(row, term, share): what each term discloses at most of an entity of its row, from the threshold on.

    ``found`` has row, text, _hash, _base and _entities.
    """
    first = found.groupBy("_hash").agg(F.min("row").alias("row")).select("row")
    repeats = stored(found.select("row").join(first, "row", "left_anti"), "repeats")
    total = found.count() - repeats.count()
    once = found.join(repeats, "row", "left_anti")
    term_counts = once.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("with_term"))

    told = found.where(F.size("_base") > 0)
    owned = told.select("row", F.explode("_entities").alias("entity"))
    counts = owned.join(repeats, "row", "left_anti").groupBy("entity").agg(F.count("*").alias("with_entity"))
    owned = stored(owned.join(counts, "entity").where(F.col("with_entity") < total), "entities")
    ends = owned.groupBy("row").agg(F.min("with_entity").alias("rarest"), F.max("with_entity").alias("commonest"))

    # a term of more texts than this cannot tell of the commonest entity, nor of any other of the row
    p = F.col("commonest") / F.lit(float(max(total, 1)))
    most = (F.col("commonest") + SMOOTH * p) / F.pow(p, F.lit(1 - GENERALISE)) - SMOOTH
    own = told.select("row", terms_of(F.col("text")).alias("terms")).join(ends, "row")
    own = own.select("row", "rarest", most.alias("most"), F.explode("terms").alias("term"))
    own = own.join(term_counts, "term").where(F.col("with_term") <= F.col("most") * (1 + 1e-9))
    own = stored(own.select("row", "term", "with_term", "rarest"), "rare-terms")

    alone = own.where((F.col("with_term") == 1) | (F.col("rarest") == 1)).select(
        "row", "term", share(F.lit(1), F.col("rarest"), F.col("with_term"), total).alias("share"))

    def shared(both: Column) -> Column:
        return share(both, F.col("with_entity"), F.col("with_term"), total)

    met = own.where("with_term > 1").drop("rarest").join(owned.where("with_entity > 1"), "row")
    met = stored(met.where(shared(F.least("with_entity", "with_term")) >= GENERALISE), "met")
    pairs = met.join(repeats, "row", "left_anti").groupBy("entity", "term", "with_entity", "with_term").agg(F.count("*").alias("both"))
    pairs = pairs.select("entity", "term", shared(F.col("both")).alias("share")).where(F.col("share") >= GENERALISE)
    several = met.select("row", "entity", "term").join(pairs, ["entity", "term"]).select("row", "term", "share")
    return alone.where(F.col("share") >= GENERALISE).unionByName(several).groupBy("row", "term").agg(F.max("share").alias("share"))


def _found(docs: DataFrame, id: str, text: str) -> DataFrame:
    """row, doc_id, text, the rules' finds, and ``added``: the places of disclosing terms; row numbers the rows."""
    slim = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    found = stored(ruled(slim).withColumn("_hash", F.xxhash64(text_of("text"))), "personal")
    told = stored(disclosing(found), "disclosing")
    # texts with a disclosing term come apart where letters begin and end; lengths up to a piece make its place
    some = found.where(F.size("_base") > 0).select("row", "text")
    pieces = some.join(told.select("row").distinct(), "row").select("row", F.posexplode(F.split("text", EDGE)).alias("at", "piece"))
    so_far = F.sum(F.length("piece")).over(Window.partitionBy("row").orderBy("at"))
    places = pieces.withColumn("end", so_far.cast("int")).where(F.col("piece").rlike(TERM))
    kind = F.when(F.col("share") >= REMOVE, 5).otherwise(4)
    added = places.withColumn("term", F.lower("piece")).join(told, ["row", "term"]).groupBy("row").agg(
        F.collect_list(F.struct((F.col("end") - F.length("piece")).alias("start"), kind.alias("kind"), "end")).alias("added"))
    none = F.array().cast(f"array<{_SPAN}>")
    outside = F.when(F.col("added").isNull(), none).otherwise(spans.apart(F.col("added"), F.col("_base"), _SPAN))
    return found.join(stored(added, "terms"), "row", "left").withColumn("added", outside)


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, doc_id, n_email, n_ip, n_card, n_phone, n_term, base, spans); row numbers the rows of this result's scan.

    Spans of kind 4 are to be generalised, of kind 5 to be removed.
    """
    return _found(docs, id, text).select(
        "row", "doc_id", *(F.col(f"_n_{k}").alias(f"n_{k}") for k in KINDS[:RULES]), F.size("added").cast("long").alias("n_term"),
        F.col("_base").alias("base"), F.array_sort(F.concat("_base", "added")).alias("spans"),
    )


def digest(scan_rows: DataFrame) -> DataFrame:
    """The scan with base_sha256 and spans as text."""
    return scan_rows.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(spans.listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans.listed(F.col("spans"), KINDS).alias("spans"), "n_term",
    )


def sanitised(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text): rules' finds replaced by their kind, disclosing terms by [TERM] or by nothing."""
    rows = _found(docs, id, text).select("doc_id", "text", F.array_sort(F.concat("_base", "added")).alias("spans"))
    done = spans.masked(text_of("text"), F.col("spans"), MARKS)
    return rows.select("doc_id", F.when(F.size("spans") > 0, done).otherwise(F.col("text")).alias("text"))
