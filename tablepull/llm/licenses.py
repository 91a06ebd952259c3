"""License scans: ordered signature rules over the words of texts, gated by keywords.

A text becomes lower-case words with one blank around each. Texts without any stem of the
rules are done. The others are read in chunks of words, which overlap by more than the longest
rule on both sides; in a chunk only the rules whose keyword it holds are tried, at every word.
Of nested detections the one of lower priority goes, then the shorter one, then that
of the later rule. Everything is an expression on the row: no shuffle, built-in functions only.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablepull.functions.names import qcol
from tablepull.llm.license_rules import MAX_WORDS, RULES, STEMS, Rule

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# Words of a chunk, without its overlaps.
CHUNK_WORDS = 1024
# How sure a phrase makes.
PHRASE_WEIGHT = 0.8
# Around a match inside a chunk; texts hold no such characters any more.
_OPEN, _SHUT = "\u0001", "\u0002"
_RULE = "array<struct<keyword: string, rules: array<struct<label: string, pattern: string, priority: int, weight: double, place: int>>>>"
_PLACES = "array<struct<n: bigint, first: bigint, last: bigint, label: string>>"
_HIT = "array<struct<label: string, priority: int, weight: double, place: int, start: bigint, words: bigint>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def plain_words(text: Column) -> Column:
    """The words with one blank before, between and after them; a single blank if there is none."""
    words = F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD, " ")
    return F.regexp_replace(F.concat(F.lit(" "), F.trim(words), F.lit(" ")), "^ +$", " ")


def _blanks(text: Column) -> Column:
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(" ")))).cast("long")


def _phrase(norm: Column, phrase: str) -> Column:
    """(n, first, last): the places of a phrase, and the words before the first and the last one."""
    pieces = F.split(norm, f" (?={phrase} )", -1)
    found = _let(pieces, lambda p: F.struct(
        (F.size(p) - 1).cast("long").alias("n"),
        F.when(F.size(p) > 1, _blanks(F.get(p, F.lit(0)))).alias("first"),
        F.when(F.size(p) > 1, _blanks(norm) - 1 - _blanks(F.element_at(p, -1))).alias("last"),
    ))
    none = F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("first"), F.lit(None).cast("long").alias("last"))
    return F.when(F.contains(norm, F.lit(f" {phrase} ")), found).otherwise(none)


def _rule_table(rules: Sequence[Rule]) -> Column:
    """Rules by keyword, as a constant."""
    groups: dict[str, list[dict]] = {}
    for place, rule in enumerate(rules):
        groups.setdefault(rule.keyword, []).append({"label": rule.label, "pattern": rf" (?=({rule.pattern}) )", "priority": rule.priority, "weight": rule.weight, "place": place})
    return F.from_json(F.lit(json.dumps([{"keyword": k, "rules": r} for k, r in groups.items()])), _RULE)


def _matches(chunk: Column, rule: Column) -> Column:
    """Every word at which a rule matches, and the words of the match."""
    marked = F.regexp_replace(chunk, rule["pattern"], F.lit(f"{_OPEN}$1{_SHUT} "))

    def hits(pieces: Column) -> Column:
        rest = F.transform(pieces, lambda p: _blanks(F.substring_index(p, _SHUT, -1)))

        def hit(i: Column, before: Column) -> Column:
            match = F.substring_index(F.element_at(pieces, i + 1), _SHUT, 1)
            start = F.aggregate(F.slice(before, 1, i), F.lit(0).cast("long"), lambda a, b: a + b)
            return F.struct(rule["label"], rule["priority"], rule["weight"], rule["place"], start.alias("start"), (_blanks(match) + 1).alias("words"))

        found = _let(rest, lambda before: F.transform(F.sequence(F.lit(1), F.size(pieces) - 1), lambda i: hit(i, before)))
        return F.when(F.size(pieces) > 1, found).otherwise(F.array().cast(_HIT))

    return _let(F.split(marked, _OPEN, -1), hits)


def _beaten(hit: Column, other: Column) -> Column:
    """Whether ``hit`` and ``other`` are nested and ``other`` goes before."""
    last, other_last = hit["start"] + hit["words"], other["start"] + other["words"]
    inside = (hit["start"] >= other["start"]) & (last <= other_last)
    around = (hit["start"] <= other["start"]) & (last >= other_last)
    rank = [F.struct(h["priority"].alias("p"), h["words"].alias("w"), (-h["place"]).alias("o")) for h in (hit, other)]
    return (inside | around) & (rank[0] < rank[1])


def _chunk_hits(chunk: Column, first: Column, own: Column, size: int, rules: Column) -> Column:
    """The detections that start among the ``size`` words from ``own`` on, nested ones settled; ``first`` is the chunk's first word."""
    tried = F.flatten(F.transform(F.filter(rules, lambda g: F.contains(chunk, g["keyword"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(tried, lambda rule: _matches(chunk, rule)))

    def settled(hits: Column) -> Column:
        mine = F.filter(hits, lambda h: (h["start"] + first >= own) & (h["start"] + first < own + size))
        kept = F.filter(mine, lambda h: ~F.exists(hits, lambda other: _beaten(h, other)))
        return F.transform(kept, lambda h: h.withField("start", h["start"] + first))

    return _let(found, settled)


def _detections(norm: Column, rules: Sequence[Rule], chunk_words: int) -> Column:
    table = _rule_table(rules)

    def in_chunks(words: Column) -> Column:
        def chunk_hits(own: Column) -> Column:
            first = F.greatest(own - MAX_WORDS, F.lit(0))
            part = F.slice(words, first + 1, own - first + F.lit(chunk_words + 2 * MAX_WORDS))
            text = F.concat(F.lit(" "), F.array_join(part, " "), F.lit(" "))
            return _let(text, lambda chunk: F.when(_any(chunk, STEMS), _chunk_hits(chunk, first.cast("long"), own.cast("long"), chunk_words, table)).otherwise(F.array().cast(_HIT)))

        starts = F.sequence(F.lit(0), F.size(words) - 1, F.lit(chunk_words))
        return F.flatten(F.transform(starts, chunk_hits))

    found = _let(F.split(F.trim(norm), " ", -1), in_chunks)
    return F.when(_any(norm, STEMS), found).otherwise(F.array().cast(_HIT))


def _any(text: Column, parts: Sequence[str]) -> Column:
    out = F.lit(False)
    for part in parts:
        out = out | F.contains(text, F.lit(part))
    return out


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan_licenses(
    docs: DataFrame, phrases: Sequence[tuple[str, str]], rules: Sequence[Rule] = RULES, text_col: str = "text", chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Every row of ``docs`` with (n_words, n_base, first_word, last_word, base_labels, labels, score, detections).

    Words are runs of 0-9, a-z (after lower-casing A-Z) and characters beyond ASCII. A phrase
    (words, label) counts wherever its words stand consecutively: ``n_base`` such places, ``first_word``
    and ``last_word`` the smallest and the largest start (null without one), ``base_labels`` their labels.
    ``detections`` are those of the rules that no nested one beats, as (label, priority, weight,
    place of the rule, start, words), in no order; ``labels`` holds their labels and those of the phrases, sorted, distinct and
    joined by commas (empty if none); ``score`` is the largest weight of what was found, 0 without.

    A null text counts as empty: no words, no labels. Rows are judged one by one: repeated rows
    and ids come back as they are, an empty table gives an empty result, columns of these names are
    replaced and all others kept. A text is read whole, in chunks of ``chunk_words``; one row's text and words must fit a task.
    """
    docs = docs.drop("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections")
    norm, found = "__norm", "__found"
    out = docs.withColumn(norm, plain_words(qcol(text_col)))
    out = out.withColumn(found, F.struct(
        (_blanks(F.col(norm)) - 1).alias("n_words"),
        F.array(*[_phrase(F.col(norm), phrase).withField("label", F.lit(label)) for phrase, label in phrases]).cast(_PLACES).alias("phrases"),
        _detections(F.col(norm), rules, chunk_words).alias("detections"),
    ))
    places = F.col(f"{found}.phrases")
    hit = F.filter(places, lambda p: p["n"] > 0)
    base = F.transform(hit, lambda p: p["label"])
    weights = F.concat(F.transform(F.col(f"{found}.detections"), lambda h: h["weight"]), F.transform(hit, lambda _: F.lit(PHRASE_WEIGHT)))
    return out.select(
        *[qcol(name) for name in docs.columns],
        F.col(f"{found}.n_words").alias("n_words"),
        F.aggregate(places, F.lit(0).cast("long"), lambda a, p: a + p["n"]).alias("n_base"),
        F.array_min(F.transform(places, lambda p: p["first"])).alias("first_word"),
        F.array_max(F.transform(places, lambda p: p["last"])).alias("last_word"),
        _joined(base).alias("base_labels"),
        _joined(F.concat(base, F.transform(F.col(f"{found}.detections"), lambda h: h["label"]))).alias("labels"),
        F.coalesce(F.array_max(weights), F.lit(0.0)).alias("score"),
        F.col(f"{found}.detections").alias("detections"),
    )
