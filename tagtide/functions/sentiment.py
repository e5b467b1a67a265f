"""Sentence splitting and sentiment classes 0 (very negative) to 4 (very positive)."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

POSITIVE = (
    "amazing awesome beautiful best better brilliant congratulations cool delight enjoy excellent "
    "excited fantastic fun glad good great happy hope inspiring joy kind love lovely lucky nice "
    "perfect pretty proud smile strong success superb sweet thanks win winner wonderful wow yay"
).split()
NEGATIVE = (
    "abuse afraid angry annoying awful bad boring broken corrupt crime cruel cry damage dead death "
    "disaster disgusting evil fail failure fake fear fraud hate horrible hurt kill lie lose lost "
    "pain poor sad scared shame sick sorry stupid terrible tragedy ugly victim war weak worst wrong"
).split()

NEUTRAL = 2
TOP_CLASS = 4


def sentences(text: Column) -> Column:
    """Pieces between sentence-ending marks that hold more than blanks."""
    return F.filter(F.split(text, "[.!?]+"), lambda s: s.rlike(r"\S"))


def lexicon_class(sentence: Column) -> Column:
    """2 + positive words - negative words, kept within 0..4.

    The hash-set filter leaves few words for the loop that adds them up.
    """
    words = F.split(F.lower(sentence), r"\W+")
    known = F.filter(words, lambda word: word.isin(POSITIVE + NEGATIVE))
    balance = F.aggregate(
        known,
        F.lit(NEUTRAL),
        lambda total, word: total + F.when(word.isin(POSITIVE), 1).otherwise(-1),
    )
    return F.greatest(F.lit(0), F.least(F.lit(TOP_CLASS), balance))


def mean_class(classes: Column) -> Column:
    """Whole-number mean of the sentence classes, neutral when there is none."""
    zero = F.lit(0)
    mean = F.aggregate(
        classes,
        F.struct(zero.alias("total"), zero.alias("count")),
        lambda sums, c: F.struct((sums["total"] + c).alias("total"), (sums["count"] + 1).alias("count")),
        lambda sums: F.floor(F.try_divide(sums["total"], sums["count"])).cast("int"),
    )
    return F.coalesce(mean, F.lit(NEUTRAL))


def lexicon_mean(pieces: Column) -> Column:
    """Score of a text that is already split."""
    return mean_class(F.transform(pieces, lexicon_class))


def lexicon_score(text: Column) -> Column:
    return lexicon_mean(sentences(text))


def model_score(load_model: Callable[[], Callable[[list[str]], list[int]]]) -> Callable[[Column], Column]:
    """A scorer around a model that maps sentences to classes.

    ``load_model`` runs once per task, and the model is called once per batch, with
    the sentences of all its rows; only sentences cross to Python, in Arrow batches.
    """

    @F.pandas_udf("array<int>")
    def classes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for batch in batches:
            counts = [0 if found is None else len(found) for found in batch]
            flat = [sentence for found in batch if found is not None for sentence in found]
            classes = iter(int(c) for c in model(flat)) if flat else iter(())
            yield pd.Series(
                [None if found is None else list(islice(classes, n)) for found, n in zip(batch, counts, strict=True)]
            )

    return lambda text: mean_class(classes(sentences(text)))


def percent(score: Column) -> Column:
    return score / F.lit(TOP_CLASS) * F.lit(100)
