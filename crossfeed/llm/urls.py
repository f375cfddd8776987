"""URL filters: rules first, else naive Bayes over the words of host and path.

Host names are often several words written as one. A unigram model of the words of the pages' own visible text splits
every label of a host by Viterbi; pieces that are no known word cost more the longer they are. The words of host and
path, hashed to ``TOKENS`` counters, are judged by multinomial naive Bayes. It learns from the urls that a rule decides.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crossfeed.llm.common import in_small_batches, most_frequent, settled

#: Most frequent words of the unigram model; counted over all pages. Bounds what is sent to the workers.
VOCABULARY = 50_000
#: Longest word that a label is split into.
LONGEST = 24
#: Counters of the naive Bayes model.
TOKENS = 1 << 16
#: What a step of an unknown piece costs, in natural logarithms, and each of its letters.
UNKNOWN_PIECE, UNKNOWN_LETTER = 8.0, 2.5

#: host, path and verdict of the rules.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))

_ASCII_UPPER, _ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; empty without ``://``."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _ASCII_UPPER, _ASCII_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to the next ``?`` or ``#``; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a domain above it and the start of the path, or NULLs."""
    rule = verdict = F.lit(None).cast("string")
    for domain, start, decision in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        rule = F.when(fits, domain + start).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def vocabulary(texts: DataFrame, text_col: str, size: int = VOCABULARY) -> dict[str, float]:
    """Costs of the at most ``size`` most frequent words of a column of HTML or plain text, counted over all rows."""
    plain = F.lower(F.regexp_replace(F.col(text_col), r"(?s)<[^>]*>", " "))
    words = texts.select(F.explode(F.regexp_extract_all(plain, F.lit(r"\p{L}{2,%d}" % LONGEST), F.lit(0))).alias("word"))
    top = most_frequent(settled(words.groupBy("word").agg(F.count("*").alias("n"))), size).collect()
    total = sum(row["n"] for row in top)
    return {row["word"]: math.log(total / row["n"]) for row in top}


def segment(label: str, costs: dict[str, float]) -> list[str]:
    """The words of one host label by Viterbi; digits stay together, hyphens and underscores separate."""
    out = []
    for part in re.findall(r"[0-9]+|[^0-9_-]+", label):
        best, back = [0.0] + [math.inf] * len(part), [0] * (len(part) + 1)
        for end in range(1, len(part) + 1):
            for start in range(max(0, end - LONGEST), end):
                known = costs.get(part[start:end])
                cost = best[start] + (UNKNOWN_PIECE + UNKNOWN_LETTER * (end - start) if known is None else known)
                if cost < best[end]:
                    best[end], back[end] = cost, start
        words, end = [], len(part)
        while end:
            words.append(part[back[end]:end])
            end = back[end]
        out += words[::-1]
    return out


def tokens(host: str, path: str, costs: dict[str, float], seen: dict[str, list[str]]) -> list[str]:
    """The tokens of a url. ``seen`` keeps the words of labels that came before, within a batch."""
    out = []
    for label in host.split("."):
        if label not in seen:
            seen[label] = ["h:" + w for w in segment(label, costs)]
        out += seen[label]
    return out + ["p:" + w for w in re.findall(r"[^\W\d_]+|[0-9]+", path.lower())]


def _place(token: str) -> int:
    value = 2166136261
    for byte in token.encode("utf-8", "replace"):
        value = ((value ^ byte) * 16777619) & 0xFFFFFFFF
    return (value ^ (value >> 15)) % TOKENS


def _tokenized(frame: DataFrame, costs: dict[str, float], keep: str) -> DataFrame:
    """(keep, places) of a frame (keep, host, path)."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: dict[str, list[str]] = {}
            yield pd.DataFrame({keep: batch[keep], "places": [[_place(t) for t in tokens(h, p, costs, seen)]
                                                              for h, p in zip(batch["host"], batch["path"])]})
    return frame.select(keep, "host", "path").mapInPandas(rows, f"{keep} string, places array<int>")


def train(pages: DataFrame, url_col: str = "url", text_col: str = "html", rules: tuple = RULES,
          vocabulary_size: int = VOCABULARY) -> dict:
    """Word costs, and per counter how much it speaks for ``block``, from the urls that a rule decides.

    NULL urls and texts teach nothing. If the rules give only one verdict, or none, nothing speaks for ``block``.
    """
    costs = vocabulary(pages, text_col, vocabulary_size)
    parts = in_small_batches(pages).select(host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = parts.withColumn("verdict", rule_of(F.col("host"), F.col("path"), rules)[1]).filter("verdict IS NOT NULL")
    counted = (_tokenized(known, costs, "verdict").select("verdict", F.explode("places").alias("place"))
               .groupBy("verdict", "place").agg(F.count("*").alias("n")).toPandas())
    urls = {row["verdict"]: row["n"] for row in known.groupBy("verdict").agg(F.count("*").alias("n")).collect()}
    weights, prior = np.zeros(TOKENS), -1.0
    if len(urls) == 2:
        prior, table = math.log(urls["block"] / urls["allow"]), {}
        for verdict in ("block", "allow"):
            part = counted[counted["verdict"] == verdict]
            table[verdict] = np.bincount(part["place"].to_numpy(int), part["n"].to_numpy(float), TOKENS) + 1.0
        weights = np.log(table["block"] / table["block"].sum()) - np.log(table["allow"] / table["allow"].sum())
    return {"costs": costs, "weights": weights, "prior": prior, "rules": rules}


def judge(pages: DataFrame, model: dict, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, block_score) of every row.

    ``verdict`` is the rule's, else ``block`` if the model's log odds ``block_score`` are above 0. NULL urls and urls
    without ``://`` have an empty host and path, which no rule fits and the model's prior decides. Repeated rows stay.
    """
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    costs, weights, prior = model["costs"], model["weights"], model["prior"]

    def odds(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        seen: dict[str, list[str]] = {}
        return pd.Series([prior + float(sum(weights[_place(t)] for t in tokens(h, p, costs, seen)))
                          for h, p in zip(hosts, paths)], dtype=float)

    frame = in_small_batches(pages).select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    frame = frame.withColumn("block_score", F.pandas_udf(odds, "double")("host", "path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), model["rules"])
    judged = F.when(F.col("block_score") > 0, "block").otherwise("allow")
    return frame.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, judged).alias("verdict"),
                        "block_score")
