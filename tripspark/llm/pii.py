"""Personal data by weak supervision, with DataFrame functions only.

1. Patterns find spans in whole texts. Those of ``BASE`` that pass their checks are always results; the others, and those of the
   wider patterns, are candidates.
2. Four labelers vote on every span for, against or not at all: the span's own form (regular expressions, checksums), a
   gazetteer (domain ends, country and issuer prefixes, credential names, private networks), words of the context, and
   the surroundings (borders, monotonous digits).
3. Spans with equal votes are counted; expectation-maximisation over these counts (their number is bounded by kinds and votes, not
   by data) estimates how reliable each labeler is, and the probability of each pattern of votes.
4. A logistic regression over the same counted patterns learns these probabilities from votes, kind and shape; as a column
   expression it decides each candidate; one that
   overlaps a base span is dropped, as that span stands already.

Offsets: ``split`` gives the text between matches, so a running sum of lengths (by document) gives every match its place in code
points. Only spans are shuffled, never texts.

Null text is empty; such and clean documents have empty results. Rows that repeat (same id, same text) have the same spans each.
Empty tables give empty results. Other columns are not read (``redact`` keeps them).
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripspark.llm.common import row_hash, stored

#: Order of kinds in results.
KINDS = ["email", "ip", "card", "phone", "ssn", "iban", "secret"]
BASE = KINDS[:4]
_EMAIL = "[A-Za-z0-9._%+-]"
#: Name, kind, pattern, and a cheap test a text must pass first. Matches are leftmost and don't overlap. Runs are possessive and start
#: at a border or where the last match ended, which finds the same spans without trying every position of a run.
PATTERNS: list[tuple[str, str, str, str]] = [
    ("email", "email", rf"(?:\G|(?<!{_EMAIL})){_EMAIL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "contains(text, '@')"),
    ("ip", "ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", r"text rlike '[0-9]\\.[0-9]'"),
    ("card", "card", r"[0-9](?:[\x20-]?[0-9])++", r"text rlike '[0-9][ -]?[0-9]'"),
    ("phone", "phone", r"\+[0-9][\x20().0-9-]+[0-9]", "contains(text, '+')"),
    ("email_spelled", "email", rf"(?:\G|(?<!{_EMAIL})){_EMAIL}++ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(] ?dot ?[\])]|\.) ?[A-Za-z0-9-]++)++",
     r"text rlike '[\\[(] ?at ?[\\])]'"),
    ("phone_local", "phone", r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9.-])", r"text rlike '[0-9]{3}[ .-][0-9]{4}'"),
    ("ssn", "ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", r"text rlike '[0-9]-[0-9]{2}-[0-9]'"),
    ("iban", "iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])", r"text rlike '[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}'"),
    ("secret", "secret", r"(?i)(?<=(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\x22']? ?[:=] ?[\x22']?)[A-Za-z0-9_+/=-]{16,}+",
     r"text rlike '(?i)(token|secret|passw|key)[\\x22\']? ?[:=]'"),
]
#: Fixed lists of the gazetteer and context labelers.
DOMAIN_ENDS = "com|org|net|edu|gov|io|info|biz|de|fr|es|it|uk|co|eu|us|ca|ch|at|nl|be|pt|br|mx|jp|cn|in|au"
COUNTRY_CODES = r"1|7|2[07]|2[1-69][0-9]|3[0-469]|3[578][0-9]|4[013-9]|42[0-9]|5[1-8]|5[09][0-9]|6[0-6]|6[7-9][0-9]|8[1246]|8[58][0-9]|9[0-58]|9[679][0-9]"
ISSUERS = r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30[0-5]|36|38"
CONTEXT = {"email": "mail|contact|write|reach", "ip": r"\bip\b|address|host|server|login", "card": "card|visa|mastercard|credit|debit|payment|amex",
           "phone": r"phone|\btel|call|mobile|fax|contact", "ssn": r"ssn|social|security|\btax", "iban": "iban|account|bank|transfer",
           "secret": "token|secret|passw|key|credential"}
AGAINST = r"version|isbn|order|invoice|figure|page|serial|chapter|commit|build|release"
LABELERS = ["form", "gazetteer", "context", "surroundings"]
BEFORE, AFTER = 40, 20


def literal_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small DataFrame of the given rows, made by a SQL expression."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("r")).select("r.*")


def _part(pattern: int):
    """A match (null after the last) and the text between it and the one before, cut to what is needed of it."""
    return lambda x, i: F.struct(F.lit(pattern).alias("pattern"), i.alias("pos"), F.length(x["piece"]).alias("gap"),
                                 F.left(x["piece"], F.lit(AFTER)).alias("head"), F.right(x["piece"], F.lit(BEFORE)).alias("before"), x["span"].alias("span"))


def _spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every match: rid, pattern, kind, start, end, span, before, after. ``rid`` is the hash of id and text."""
    text = F.col("text")
    kind = "array<struct<pattern:int,pos:int,gap:int,head:string,before:string,span:string>>"
    each = []
    for k, (_, _, pattern, test) in enumerate(PATTERNS):
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        parts = F.transform(F.arrays_zip(found.alias("span"), F.split(text, pattern, -1).alias("piece")), _part(k))
        each.append(F.when(F.expr(test), F.when(F.size(parts) > 1, parts)).otherwise(F.array().cast(kind)))
    rows = (docs.select(row_hash(id_col, text_col).alias("rid"), F.col(text_col).alias("text"))
            .select("rid", F.inline(F.concat(*[F.coalesce(e, F.array().cast(kind)) for e in each])))
            .dropDuplicates(["rid", "pattern", "pos"]))
    order = Window.partitionBy("rid", "pattern").orderBy("pos")
    size = F.coalesce(F.length("span"), F.lit(0)).cast("long")
    behind = F.sum(F.col("gap") + size).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    kinds = F.element_at(F.array(*[F.lit(p[1]) for p in PATTERNS]), F.col("pattern") + 1)
    return (rows.withColumn("end", behind).withColumn("after", F.lead("head").over(order)).filter("span is not null")
            .select("rid", "pattern", kinds.alias("kind"), (F.col("end") - size).alias("start"), "end", "span", "before", "after"))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    places = F.reverse(F.split(digits, ""))
    value = lambda d, i: F.when(i % 2 == 1, F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)).otherwise(d)
    return F.aggregate(F.transform(F.filter(places, lambda x: x != ""), lambda x, i: value(x.cast("int"), i)), F.lit(0), lambda a, x: a + x) % 10 == 0


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _labelled(spans: DataFrame) -> DataFrame:
    """Spans with ``base`` (a base pattern whose check passes), the labelers' votes and shape features."""
    span, kind, digits = F.col("span"), F.col("kind"), F.col("digits")
    n = F.length("digits")
    octets = F.forall(F.split(span, r"\."), lambda x: (F.length(F.ltrim(x, F.lit("0"))) <= 3) & (F.coalesce(F.ltrim(x, F.lit("0")).try_cast("int"), F.lit(0)) <= 255))
    is_card = n.between(13, 19) & luhn(F.when(n.between(13, 19), digits).otherwise(F.lit("1")))
    never = F.lit(False)
    of = lambda pairs: F.coalesce(*[F.when(kind == k, v) for k, v in pairs.items()], never)
    base = F.col("pattern") < len(BASE)
    passes = of({"email": F.lit(True), "ip": octets, "card": is_card, "phone": n.between(9, 15)})
    form = _vote(of({"email": span.rlike(r"^[A-Za-z0-9][^@]*[A-Za-z0-9] ?(@|[\[(] ?at ?[\])]).*[A-Za-z]{2,24}$"), "ip": octets, "card": is_card,
                     "phone": n.between(9, 15), "ssn": ~span.rlike("^(000|666|9)|-00-|-0000$"), "iban": n >= 8,
                     "secret": span.rlike("[0-9]") & span.rlike("[A-Za-z]") & (F.length("span") >= 20)}), F.lit(True))
    gazetteer = _vote(of({"email": span.rlike(rf"(?i)(\.|dot ?[\])] ?)({DOMAIN_ENDS})$"), "card": digits.rlike(f"^({ISSUERS})"),
                          "phone": span.rlike(rf"^\+({COUNTRY_CODES})"), "iban": span.rlike("^(DE|FR|ES|IT|GB|NL|BE|AT|CH|PT|PL|IE|LU|DK|SE|FI|NO)"),
                          "secret": F.col("before").rlike("(?i)(token|secret|password|key)")}),
                      of({"ip": span.rlike(r"^(0|10|127|255|192\.168|172\.(1[6-9]|2[0-9]|3[01]))\."), "card": F.lit(True)}))
    context = _vote(F.coalesce(*[F.when(kind == k, F.lower("before").rlike(x)) for k, x in CONTEXT.items()], never), F.lower("before").rlike(AGAINST))
    glued = F.col("before").rlike(r"[\p{L}\p{N}_]$") | F.col("after").rlike(r"^[\p{L}\p{N}_]")
    dull = (n >= 6) & digits.rlike(r"^([0-9])\1*$|^0?123456789|^9876543210")
    surroundings = _vote(~glued & ~dull, F.lit(True))
    return (spans.withColumn("digits", _digits(span)).withColumn("base", base & passes)
            .withColumns({"form": form, "gazetteer": gazetteer, "context": context, "surroundings": surroundings,
                          "long": (F.length("span") >= 24).cast("int"), "spaced": span.contains(" ").cast("int")})
            .filter(F.col("base") | ~base | ((kind == "card") & n.between(13, 19)) | ((kind == "phone") & n.between(7, 15))))


SHAPE = ["long", "spaced"]


def estimate(patterns: Iterable[dict], rounds: int = 40) -> tuple[list[float], dict]:
    """Expectation-maximisation over counted vote patterns (kind, votes, n): each pattern's probability of personal data, and
    the labelers' rates P(vote | class). Starts from the majority of votes; a prior for each kind; one pseudo-count."""
    rows = list(patterns)
    p = [1 / (1 + math.exp(-1.5 * sum(r[x] for x in LABELERS))) for r in rows]
    rates: dict = {}
    for _ in range(rounds):
        prior = {}
        for k in {r["kind"] for r in rows}:
            mine = [(q, r["n"]) for q, r in zip(p, rows, strict=True) if r["kind"] == k]
            prior[k] = (1 + sum(q * n for q, n in mine)) / (2 + sum(n for _, n in mine))
        for x in LABELERS:
            for c in (0, 1):
                each = {v: 1.0 for v in (-1, 0, 1)}
                for q, r in zip(p, rows, strict=True):
                    each[r[x]] += (q if c else 1 - q) * r["n"]
                rates[x, c] = {v: m / sum(each.values()) for v, m in each.items()}
        p = []
        for r in rows:
            odds = math.log(prior[r["kind"]] / (1 - prior[r["kind"]])) + sum(math.log(rates[x, 1][r[x]] / rates[x, 0][r[x]]) for x in LABELERS)
            p.append(1 / (1 + math.exp(-max(-30.0, min(30.0, odds)))))
    return p, rates


#: Inputs of the span classifier: column, and the value that counts as 1.
FEATURES = [*((x, v) for x in LABELERS for v in (1, -1)), *((x, 1) for x in SHAPE), *(("kind", k) for k in KINDS)]


def fit_logistic(rows: list[dict], p: list[float], ridge: float = 1e-3, rounds: int = 50) -> list[float]:
    """Logistic regression of the patterns' probabilities on ``FEATURES``, each pattern weighing its count; the bias is last."""
    x = np.array([[float(r[c] == v) for c, v in FEATURES] + [1.0] for r in rows])
    n, p = np.array([r["n"] for r in rows], float), np.array(p)
    pull = np.full(x.shape[1], ridge * n.sum())
    pull[-1] = 1e-9 * n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (n * q * (1 - q))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(h, x.T @ (n * (q - p)) + pull * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def classifier(labelled: DataFrame) -> Column:
    """Fit the reliabilities and the final classifier on all spans; returns its probability as an expression."""
    counted = labelled.groupBy("kind", *LABELERS, *SHAPE).agg(F.count("*").alias("n")).collect()  # at most 7 * 3**4 * 4 rows
    rows = sorted((r.asDict() for r in counted), key=lambda r: json.dumps(r, sort_keys=True))
    if not rows:
        return F.lit(0.0)
    p, _ = estimate(rows)
    *weights, bias = fit_logistic(rows, p)
    z = F.lit(bias)
    for (c, v), w in zip(FEATURES, weights, strict=True):
        z = z + F.when(F.col(c) == F.lit(v), F.lit(w)).otherwise(F.lit(0.0))
    return 1 / (1 + F.exp(-z))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """(doc_id, spans): for each row its spans (kind, start, end, base, probability), by kind and start; code points, end exclusive."""
    spark = docs.sparkSession
    labelled = stored(spark, _labelled(_spans(docs, id_col, text_col)), "pii")
    scored = labelled.withColumn("probability", classifier(labelled))
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int")
    one = F.struct(rank.alias("rank"), "start", "end", "kind", "base", "probability")
    per = scored.filter(F.col("base") | (F.col("probability") >= threshold)).groupBy("rid").agg(
        F.sort_array(F.collect_set(F.when(F.col("base"), one))).alias("sure"), F.sort_array(F.collect_set(F.when(~F.col("base"), one))).alias("more"))
    overlaps = lambda x, s: (x["start"] < s["end"]) & (s["start"] < x["end"])
    more = F.filter("more", lambda x: ~F.exists("sure", lambda s: overlaps(x, s)))
    more = F.filter(more, lambda x: ~F.exists("more", lambda s: overlaps(x, s) & ((s["rank"] < x["rank"]) | ((s["rank"] == x["rank"]) & (s["start"] < x["start"])))))
    spans = F.transform(F.sort_array(F.concat("sure", more)), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"),
                                                                               x["base"].alias("base"), x["probability"].alias("probability")))
    per = per.select("rid", spans.alias("spans"))
    ids = docs.select(row_hash(id_col, text_col).alias("rid"), F.col(id_col).alias("doc_id"))
    empty = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean,probability:double>>")
    return ids.join(per, "rid", "left").select("doc_id", "rid", F.coalesce("spans", empty).alias("spans"))


def written(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; overlapping spans are one (the first names it)."""
    found = find(docs, id_col, text_col).filter(F.size("spans") > 0).select("rid", "spans").dropDuplicates(["rid"])
    # the text is cut at the spans' ends: each span gives the text since the one before, and its mark
    order = Window.partitionBy("rid").orderBy("start", F.desc("end"), "kind")
    rows = found.select("rid", F.inline("spans")).withColumn("reach", F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.filter(F.col("reach").isNull() | (F.col("end") > F.col("reach"))).withColumn("from", F.greatest(F.coalesce("reach", F.lit(0)), "start"))
    rows = rows.withColumn("mark", F.when(F.coalesce("reach", F.lit(0)) <= F.col("start"), F.concat(F.lit("["), F.upper("kind"), F.lit("]"))).otherwise(F.lit("")))
    cuts = rows.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("from", "end", "mark", F.coalesce("reach", F.lit(0)).alias("since")))).alias("cuts"))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])  # one column, so that no name of the document's can clash
    keyed = docs.select(whole.alias("row"), row_hash(id_col, text_col).alias("rid")).join(cuts, "rid", "left")
    text = F.col("row")[text_col]
    parts = F.transform("cuts", lambda c: F.concat(F.substring(text, (c["since"] + 1).cast("int"), (c["from"] - c["since"]).cast("int")), c["mark"]))
    rest = F.substring(text, (F.element_at("cuts", -1)["end"] + 1).cast("int"), F.length(text))
    redacted = F.when(F.col("cuts").isNull(), text).otherwise(F.concat(F.array_join(parts, ""), rest))
    return keyed.select(*[(redacted if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
