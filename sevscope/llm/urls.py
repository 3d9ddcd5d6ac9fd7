"""URL filters: listed rules, and naive Bayes over the words inside host names and paths.

Host names run words together. A unigram model, the word counts of all pages' texts, splits each
distinct label of a host by a Viterbi search. Only words that occur inside some label matter, so
labels offer their substrings, the counted words join them, and each label is split with its
own few words: nothing of the vocabulary is broadcast or collected.

The words of host and path are scored by a multinomial naive Bayes of two classes, learned from all
pages: a page is an example of the blocked class if one of its words is a seed or a form of one. Words are counted
in ``BUCKETS`` hash buckets, so the model has a fixed size.

Rules come first: a rule fits its host and all its subdomains if the path starts with the rule's; the
longest rule that fits decides. A page without a rule gets the method's verdict.

Defined results: a NULL url or one without ``://`` has an empty host and path, no rule and, without
words, verdict allow; repeated rows are judged row by row; an empty table gives an empty result; a
NULL html has no words; other columns are not read.
"""
from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sevscope.session import write_stage

from .common import pick

#: (verdict, host, path)
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Words that make a page an example of the blocked class, by kind of site.
CATEGORIES = {
    "adult": ("adult", "escort", "escorts", "nude", "porn", "sex", "xxx"),
    "advertising": ("ads", "adserver", "advert", "advertising", "banner", "clickbait", "popup", "sponsored"),
    "counterfeit": ("cheap", "counterfeit", "knockoff", "replica"),
    "gambling": ("bet", "betting", "casino", "gambling", "jackpot", "lottery", "poker", "roulette", "slots"),
    "loans": ("loan", "loans", "payday"),
    "malware": ("keygen", "malware", "phishing", "scam", "warez"),
    "pharmacy": ("pharmacy", "pills", "viagra"),
    "spam": ("spam", "spammer"),
}
SEEDS = tuple(w for kind in CATEGORIES.values() for w in kind)
#: Their forms in the corpus's languages (English, German, French, Spanish) besides a plural in -s.
FORMS = {
    "advertising": ("werbung", "publicité", "publicidad"),
    "lottery": ("lotteries", "lotterie", "loterie", "lotería", "loteria"),
    "adult": ("adulte", "adultes", "adulto", "adultos", "adulta", "adultas", "erwachsene"),
    "bet": ("wette", "wetten", "sportwetten", "apuesta", "apuestas"),
    "casino": ("kasino", "kasinos"),
    "cheap": ("cheaper", "cheapest", "billig", "billige", "billiger", "barato", "baratos", "barata", "baratas"),
    "gambling": ("gamble", "gambler", "gamblers", "glücksspiel", "glücksspiele", "gluecksspiel"),
    "loan": ("kredit", "kredite", "darlehen", "préstamo", "préstamos", "prestamo", "prestamos"),
    "pharmacy": ("pharmacies", "apotheke", "apotheken", "pharmacie", "farmacia", "farmacias"),
    "pills": ("pill", "pille", "pillen", "pilule", "pilules", "pastilla", "pastillas", "píldora", "píldoras"),
    "porn": ("porno",),
    "replica": ("replik", "repliken", "réplique", "répliques", "réplica", "réplicas"),
    "sex": ("sexe", "sexo"),
}
BUCKETS = 1 << 16
LONGEST = 20  # characters of a word inside a host name at least, longer ones as far as counted words go
LABEL = 63  # characters a host label has at most, by the rules of host names
LETTERS = "\\p{L}[\\p{L}\\p{M}]*"  # of any script
NUMBER = "0"
SMOOTH = 1.0


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both NULL if none does."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1:]))
    fits = [(v, host_ + path_, ((h == host_) | h.endswith("." + host_)) & p.startswith(path_)) for v, host_, path_ in longest]
    pick_ = lambda k: F.coalesce(*(F.when(f[2], F.lit(f[k])) for f in fits), F.lit(None).cast("string"))
    return pick_(1), pick_(0)


def seed_words(seeds) -> list[str]:
    """The seeds with their word forms."""
    return sorted({w for s in seeds for w in (s, *((s + "s",) if not s.endswith("s") else ()), *FORMS.get(s, ()))})


def tokens(named: Column) -> Column:
    """Runs of letters in lower case, and ``NUMBER`` for runs of digits; percent escapes are decoded."""
    decoded = F.try_url_decode(F.regexp_replace(F.regexp_replace(named, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B"))
    return F.transform(F.regexp_extract_all(F.lower(F.coalesce(decoded, named)), F.lit(LETTERS + "|\\p{N}+"), F.lit(0)),
                       lambda x: F.when(x.rlike("^\\p{N}"), NUMBER).otherwise(x))


def split_label(label: str, counts: dict[str, int], total: int, longest: int = LONGEST) -> list[str]:
    """The most likely words of a host label; parts without a known word stay whole letters' runs."""
    best: list[tuple[float, int]] = [(0.0, 0)]
    for end in range(1, len(label) + 1):
        options = []
        for start in range(max(0, end - longest), end):
            w = label[start:end]
            # unknown words get likelier the shorter they are, and less likely than any known word
            cost = math.log(total / counts[w]) if w in counts else math.log(total * 10.0) + 2.5 * len(w)
            options.append((best[start][0] + cost, start))
        best.append(min(options))
    out, end = [], len(label)
    while end:
        start = best[end][1]
        out.append(label[start:end])
        end = start
    return out[::-1]


def unigrams(pages: DataFrame) -> DataFrame:
    """(word, n): words of all pages' texts, tags left out."""
    text = F.regexp_replace(F.coalesce(pages["html"], F.lit("")), "<[^<>]*>", " ")
    return (pages.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(LETTERS), F.lit(0))).alias("word"))
            .where(F.length("word").between(2, LABEL)).groupBy("word").agg(F.count("*").alias("n")))


def segmented(hosts: DataFrame, counts: DataFrame) -> DataFrame:
    """(host, host_words) of distinct hosts."""
    labels = hosts.select(F.explode(F.array_distinct(tokens(F.col("host")))).alias("label")).distinct()
    total, longest = counts.agg(F.sum("n"), F.max(F.length("word"))).first()
    total, longest = total or 1, max(LONGEST, longest or 0)
    size = F.length("label")
    pieces = labels.select("label", F.explode(F.sequence(F.lit(1), size)).alias("at")).select(
        "label", "at", F.explode(F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.lit(longest), F.length("label") - F.col("at") + 1)))).alias("len"))
    pieces = pieces.select("label", F.substring(F.col("label"), F.col("at"), F.col("len")).alias("word")).where(F.length("word") >= 2).distinct()
    own = pieces.join(counts, "word").groupBy("label").agg(F.map_from_entries(F.collect_list(F.struct("word", "n"))).alias("known"))

    @F.pandas_udf("array<string>")
    def split(label: pd.Series, known: pd.Series) -> pd.Series:
        return pd.Series([split_label(x, dict(k) if k is not None else {}, total, longest) for x, k in zip(label, known)])

    words = labels.join(own, "label", "left").select("label", split("label", "known").alias("words"))
    # the labels of a host in their order, joined back by the distinct hosts
    placed = hosts.select("host", F.posexplode(tokens(F.col("host"))).alias("nth", "label"))
    return (placed.join(words, "label").groupBy("host").agg(F.sort_array(F.collect_list(F.struct("nth", "words"))).alias("w"))
            .select("host", F.flatten(F.transform("w", lambda x: x["words"])).alias("host_words")))


def bucket(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(BUCKETS - 1))


def fitted(rows: DataFrame, blocked: Column) -> tuple[Column, bool]:
    """Log odds of the blocked class for ``words``, learned from all rows, and whether any row is of that class."""
    counts = (rows.select(blocked.alias("blocked"), F.explode("words").alias("w")).groupBy(bucket(F.col("w")).alias("bucket"), "blocked").count())
    table = np.zeros((2, BUCKETS))
    for r in counts.collect():  # two rows a bucket at most
        table[int(r["blocked"]), r["bucket"]] += r["count"]
    pages_of = dict(rows.groupBy(blocked.alias("blocked")).count().collect())
    used = SMOOTH * max(1, int((table.sum(0) > 0).sum()))  # buckets that any word fell into
    odds = np.log((table[1] + SMOOTH) / (table[1].sum() + used)) - np.log((table[0] + SMOOTH) / (table[0].sum() + used))
    prior = math.log((pages_of.get(True, 0) + SMOOTH) / (pages_of.get(False, 0) + SMOOTH))
    sent = rows.sparkSession.sparkContext.broadcast(odds)

    @F.pandas_udf("double")
    def total(buckets: pd.Series) -> pd.Series:
        return pd.Series([prior + float(sent.value[np.asarray(b, np.int64)].sum()) for b in buckets])

    return total(F.transform("words", bucket)), bool(pages_of.get(True))


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, words, score (log odds of the blocked class)."""
    urls = pick(pages, "page_id", "url").select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    hosts = write_stage(segmented(urls.select("host").distinct(), write_stage(unigrams(pick(pages, "html")), "unigrams")), "host-words")
    named = hosts.withColumnRenamed("host", "of")
    rows = write_stage(urls.join(named, F.col("host") == F.col("of"), "left").select(
        "page_id", "host", "path", F.concat(F.coalesce("host_words", F.array().cast("array<string>")), tokens(F.col("path"))).alias("words")), "url-words")

    seeded = F.arrays_overlap("words", F.array(*(F.lit(s) for s in seed_words(seeds))))
    score, some = fitted(rows, seeded)
    r, v = rule(F.col("host"), F.col("path"), rules)
    scored = rows.withColumn("score", score)
    method = F.when((F.col("score") > 0) & F.lit(some) & (F.size("words") > 0), "block").otherwise("allow")
    return scored.select("page_id", "host", "path", r.alias("rule"), F.coalesce(v, method).alias("verdict"), F.array_join("words", " ").alias("words"), "score")


def allowed(pages: DataFrame) -> DataFrame:
    """``pages`` whose url the rules or the method allow."""
    ok = judge(pages).where("verdict = 'allow'").select(F.col("page_id").alias("__id")).distinct()
    return pages.join(ok, pages["page_id"].eqNullSafe(ok["__id"]), "left_semi")
