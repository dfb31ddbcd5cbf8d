"""URL filter: host and path rules first, then a weighted vocabulary found by one Aho-Corasick automaton.

Rules name a host (all its subdomains included) and the beginning of a path; the longest rule that fits
decides.  A url without a rule is judged by its terms: the automaton finds all vocabulary terms in the
lower-cased url in one pass; a hit counts only if no letter or digit touches it on either side.  One
strict term blocks the url, and so do at least ``DISTINCT`` different soft terms with a total weight of ``LIMIT`` or more; one
soft term alone, however heavy or often, does not.  The vocabulary is a parameter; ``read_vocabulary`` takes it from a file.

Defined results: a null url, or one without ``://``, has empty host and path and fits no rule; its text (if
any) is still judged by its terms; a null url is allowed; repeated rows are judged one by one; input columns with the names of
the added ones (host, path, rule, verdict, n_strict, n_soft, soft_weight) are replaced.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import task_udf

#: (verdict, host, beginning of the path)
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))

#: Terms that block by themselves.
STRICT = ("casino", "porn", "xxx", "viagra", "spam", "malware", "phishing", "warez", "escort", "jackpot")
#: Terms that block together, with their weights.
SOFT = {"bet": 1, "bets": 1, "free": 1, "win": 1, "poker": 2, "slots": 2, "adult": 2, "cheap": 1, "pills": 2, "loan": 1,
        "loans": 1, "sex": 2, "dating": 1, "deal": 1, "deals": 1, "farm": 1, "click": 1, "bonus": 1, "crack": 1, "torrent": 2}
LIMIT = 2
DISTINCT = 2
MOST_TERMS = 1 << 18  # of a vocabulary file; the automaton is built by every task

ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: str) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column."""
    rest = F.expr(f"coalesce(if(instr(`{url}`, '://') > 0, substr(`{url}`, instr(`{url}`, '://') + 3), ''), '')")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, ASCII_UPPER, ASCII_LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Longest rule that fits (host and path as one string) and its verdict; null if none fits."""
    rule = verdict = F.lit(None).cast("string")
    for kind, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def vocabulary_hits(url: Column, strict=STRICT, soft=SOFT) -> Column:
    """Struct of the numbers of distinct strict and soft terms and the total weight of the soft ones in a url."""
    terms = {**{t: (1, 0) for t in strict}, **{t: (0, w) for t, w in soft.items()}}

    def run(column: pa.Array) -> pa.Array:
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for t in terms:
            automaton.add_word(t, t)
        automaton.make_automaton()
        lower = str.maketrans(ASCII_UPPER, ASCII_LOWER)
        solid = set(ASCII_LOWER + "0123456789")
        n_strict, n_soft, weight = [], [], []
        for u in column.to_pylist():
            text, seen = (u or "").translate(lower), set()
            for end, t in automaton.iter(text):
                begin = end + 1 - len(t)
                if (begin == 0 or text[begin - 1] not in solid) and (end + 1 == len(text) or text[end + 1] not in solid):
                    seen.add(t)
            n_strict.append(sum(terms[t][0] for t in seen))
            n_soft.append(sum(not terms[t][0] for t in seen))
            weight.append(sum(terms[t][1] for t in seen))
        return pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (n_strict, n_soft, weight)], ["n_strict", "n_soft", "soft_weight"])

    return task_udf(run, "struct<n_strict:bigint,n_soft:bigint,soft_weight:bigint>")(url)


def read_vocabulary(spark, path: str) -> tuple[tuple[str, ...], dict[str, int]]:
    """(strict terms, soft terms with weights) of a headerless CSV file ``term,kind,weight``; kind is strict or soft.

    Terms are lower-cased (A-Z); a term that is listed as both is strict; of several weights the largest counts.  More than ``MOST_TERMS``
    terms are refused, as every task holds the automaton.
    """
    rows = spark.read.schema("term STRING, kind STRING, weight BIGINT").csv(path).filter("term is not null")
    terms = (rows.groupBy(F.translate("term", ASCII_UPPER, ASCII_LOWER).alias("term"))
             .agg(F.bool_or(F.col("kind") == "strict").alias("strict"), F.coalesce(F.max("weight"), F.lit(1)).alias("weight")))
    found = terms.orderBy("term").limit(MOST_TERMS + 1).collect()
    if len(found) > MOST_TERMS:
        raise ValueError(f"a vocabulary of more than {MOST_TERMS} terms")
    return tuple(r.term for r in found if r.strict), {r.term: r.weight for r in found if not r.strict}


def judged(pages, url: str = "url", rules=RULES, strict=STRICT, soft=SOFT, limit: int = LIMIT, distinct: int = DISTINCT):
    """Add host, path, rule, verdict, n_strict, n_soft and soft_weight to ``pages``."""
    host, path = host_path(url)
    seen = pages.withColumn("__hits", vocabulary_hits(F.col(url), strict, soft)).withColumn("__host", host).withColumn("__path", path)
    rule, verdict = rule_of(F.col("__host"), F.col("__path"), rules)
    blocked = (F.col("__hits.n_strict") > 0) | ((F.col("__hits.n_soft") >= distinct) & (F.col("__hits.soft_weight") >= limit))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "n_strict", "n_soft", "soft_weight")]
    return seen.select(*kept, F.col("__host").alias("host"), F.col("__path").alias("path"), rule.alias("rule"),
                       F.coalesce(verdict, F.when(blocked, "block").otherwise("allow")).alias("verdict"), "__hits.*")
