"""Licence scan by ordered signature rules. DataFrame functions only.

A text is looked at only if it contains an anchor; of the rules only those run whose keyword
occurs in it. Every match is an interval of words. Intervals inside another one of the same or a
higher rank are suppressed, what is left gives the labels. Rows stay where they are: nothing is
shuffled, so neither a hot source nor a repeated text makes a hot task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cartwheel.llm.common import free_names
from cartwheel.llm.license_rules import ANCHORS, RULES, SCORES

# word characters: all but ASCII other than letters and digits
_NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
_INITIALS = "".join(sorted({anchor[0] for anchor in ANCHORS}))   # one look rules most places out
_GATE = f"(?i)(?=[{_INITIALS}])(?:{'|'.join(ANCHORS)})"
_BASE = "(?<= )(?:mit|apache|general public) license(?= )"
_BASE_LABELS = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_OPEN, _CLOSE = "\x01", "\x02"   # ASCII controls separate words, so no word contains them


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _count_words(text: Column) -> Column:
    """Pieces between separators, without the empty ones at the ends."""
    ends = [F.rlike(text, F.lit(p)).cast("int") for p in ("^" + _NOT_WORD, _NOT_WORD + r"\z")]
    pieces = F.size(F.split(text, _NOT_WORD + "++"))
    return F.when(text == "", 0).otherwise(pieces - ends[0] - ends[1]).cast("long")


def _marks(words: Column, mark: Column, place) -> Column:
    """Places of the words for which ``mark`` holds, in order."""
    return F.filter(F.transform(words, lambda w, i: F.when(mark(w), place(i))), lambda x: x.isNotNull())


def _found(norm: Column, rule: Column) -> Column:
    """Intervals of words matched by one rule, ordered for the suppression that follows."""
    marked = F.regexp_replace(norm, F.concat(F.lit("(?<= )(?:"), rule["pattern"], F.lit(")(?= )")),
                              F.lit(f"{_OPEN}$0{_CLOSE}"))
    words = F.split(marked, " ")   # begins with an empty one, before the leading blank
    starts = _marks(words, lambda w: F.startswith(w, F.lit(_OPEN)), lambda i: i - 1)
    ends = _marks(words, lambda w: F.endswith(w, F.lit(_CLOSE)), lambda i: i)
    return F.zip_with(starts, ends, lambda a, b: F.struct(
        a.alias("first"), (-b).alias("minus_end"), (-rule["rank"]).alias("minus_rank"),
        rule["label"].alias("label"), rule["no"].alias("rule")))


def _rule_table(rules) -> Column:
    return F.array(*[F.struct(F.lit(no).alias("no"), F.lit(label).alias("label"),
                              F.lit(rank).alias("rank"), F.lit(keyword).alias("keyword"),
                              F.lit(pattern).alias("pattern"))
                     for no, (label, rank, keyword, pattern) in enumerate(rules)])


def _suppressed(found: Column) -> Column:
    """Without intervals inside another one of at least their rank. In order of (start, longest
    first, highest rank first) only earlier ones can contain a later one, so the furthest end
    seen so far at each rank or above is all there is to know."""
    ranks = sorted(SCORES)
    kind = "array<struct<first:int,minus_end:int,minus_rank:int,label:string,rule:int>>"
    start = F.struct(*[F.lit(-1).alias(f"t{r}") for r in ranks],
                     F.array().cast(kind).alias("kept"))

    def step(seen: Column, d: Column) -> Column:
        end, rank = -d["minus_end"], -d["minus_rank"]
        inside = reduce(lambda rest, r: F.when(rank == r, seen[f"t{r}"] >= end).otherwise(rest),
                        ranks, F.lit(False))
        return F.struct(*[F.when(rank >= r, F.greatest(seen[f"t{r}"], end)).otherwise(seen[f"t{r}"])
                          .alias(f"t{r}") for r in ranks],
                        F.when(inside, seen["kept"]).otherwise(F.concat(seen["kept"], F.array(d)))
                        .alias("kept"))
    return F.aggregate(F.array_sort(found), start, step, lambda seen: seen["kept"])


def scan_licenses(docs: DataFrame, rules=RULES, text: str = "text") -> DataFrame:
    """Add to every row: ``n_words``; ``n_base``, ``first_word``, ``last_word`` and
    ``base_labels`` of the three base phrases; ``licenses``, the detections left after
    suppression (first word, end, label, rank, rule number); ``labels`` and ``score``.

    A null text counts as empty: no words, no base phrase, empty labels, score 0. Repeated rows
    are scanned each for itself, an empty table gives an empty result, and columns of ``docs``
    that have one of the new names get ``_in`` appended.
    """
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "licenses", "labels", "score")
    docs = free_names(docs, *new, "_norm", "_pieces", "_base", "_kept")
    whole = F.coalesce(F.col(text), F.lit(""))
    lower = F.translate(whole, _UPPER, _UPPER.lower())
    norm = F.concat(F.lit(" "), F.trim(F.regexp_replace(lower, _NOT_WORD + "++", " ")), F.lit(" "))
    gated = (docs.withColumn("n_words", _count_words(whole))
             .withColumn("_norm", F.when(F.rlike(whole, F.lit(_GATE)), norm)))

    n, pieces = F.col("_norm"), F.col("_pieces")
    names = F.filter(F.array(*[F.when(n.contains(f" {phrase} "), label)
                               for phrase, label in _BASE_LABELS]), lambda x: x.isNotNull())
    rest = F.element_at(pieces, -1)
    up_to_last = F.left(n, F.length(n) - F.length(rest))
    last_size = F.when(up_to_last.endswith(" general public license"), 3).otherwise(2)
    some = F.size("_base") > 0
    base = (gated.withColumn("_base", F.when(n.isNotNull(), F.array_sort(names))
                             .otherwise(F.array().cast("array<string>")))
            .withColumn("_pieces", F.when(F.size("_base") > 0, F.split(n, _BASE)))
            .withColumn("n_base", F.when(some, F.size(pieces) - 1).otherwise(0).cast("long"))
            .withColumn("first_word", F.when(some, _blanks(F.element_at(pieces, 1)) - 1).cast("long"))
            .withColumn("last_word", F.when(some, F.col("n_words") - (_blanks(rest) - 1)
                                            - last_size).cast("long")))

    running = F.filter(_rule_table(rules), lambda r: F.contains(n, r["keyword"]))
    found = F.flatten(F.transform(running, lambda r: _found(n, r)))
    kept = F.when(n.isNotNull(), _suppressed(found))
    spans = F.transform(F.coalesce(F.col("_kept"), F.array().cast(
        "array<struct<first:int,minus_end:int,minus_rank:int,label:string,rule:int>>")),
        lambda d: F.struct(d["first"], (-d["minus_end"]).alias("end"), d["label"],
                           (-d["minus_rank"]).alias("rank"), d["rule"]))
    score = F.element_at(F.create_map(*[F.lit(x) for pair in SCORES.items() for x in pair]),
                         F.array_max(F.transform("licenses", lambda d: d["rank"])))
    return (base.withColumn("_kept", kept).withColumn("licenses", spans)
            .withColumn("labels", F.array_join(F.array_sort(F.array_distinct(F.concat(
                "_base", F.transform("licenses", lambda d: d["label"])))), ","))
            .withColumn("base_labels", F.array_join("_base", ","))
            .withColumn("score", F.when(F.size("licenses") > 0, score).otherwise(0.0))
            .select(*docs.columns, *new))


def license_digest(docs: DataFrame) -> DataFrame:
    return scan_licenses(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
