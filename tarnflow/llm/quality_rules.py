"""Quality rules as weak supervision.

Each rule votes good (+1), bad (-1) or abstains (0) on a document.  How
reliable each rule is, for good documents and for each kind of bad ones, is
estimated from how the rules agree, by expectation-maximisation over all
documents; a document's verdict is the posterior probability of being good,
not that it passes all.  Junk comes in kinds that different rules know, so
there is one kind of bad document for each rule, which starts from what that
rule rejects and stays if documents support it.

With R rules there are at most 3**R patterns of votes, however many documents
there are.  The likelihood depends on a document only by its pattern, so the
patterns' counts (one grouped count) are all that the estimation needs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .textstats import COUNTS, statistics


def _share(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """name -> vote, of the statistics' columns.  Thresholds are the usual ones
    of web-text filters, with a span between them in which a rule abstains."""
    words = F.col("n_words")
    symbols, repeats = _share("n_symbols", "n_words"), _share("n_repeat_words", "n_words")
    copies, distinct = _share("n_dup_lines", "n_lines"), _share("n_distinct_words", "n_words")
    length, upper = _share("word_chars", "n_words"), _share("n_upper", "n_letters")
    marks = _share("n_punctuation", "n_chars")
    return {
        "length": _vote(words < 50, words.between(100, 100_000)),
        "symbols": _vote(symbols > 0.1, symbols <= 0.02),
        "repeats": _vote(repeats > 0.5, repeats < 0.2),
        "copied_lines": _vote(copies > 0.3, (copies < 0.1) & (F.col("n_lines") >= 3)),
        "word_length": _vote((length < 3) | (length > 10), length.between(3.5, 9)),
        "upper_case": _vote(upper > 0.4, upper < 0.15),
        "marks": _vote(marks > 0.1, marks < 0.07),
        "variety": _vote(distinct < 0.15, distinct > 0.35),
    }


@dataclass
class VoteModel:
    """Shares of good documents and of each kind of bad ones; the probability
    that a rule's vote is +1 on good documents, and -1 on each kind of bad
    ones.  Abstaining says nothing."""

    shares: np.ndarray  # good, then each kind
    good: np.ndarray  # rule
    bad: np.ndarray  # kind, rule

    def responsibilities(self, votes: np.ndarray) -> np.ndarray:
        """P(good), P(each kind) of rows of -1, 0, 1."""
        plus, minus = (votes > 0).astype(float), (votes < 0).astype(float)
        up, down = np.vstack([self.good, 1 - self.bad]), np.vstack([1 - self.good, self.bad])
        logs = np.log(self.shares) + plus @ np.log(up).T + minus @ np.log(down).T
        logs -= logs.max(axis=1, keepdims=True)
        p = np.exp(logs)
        return p / p.sum(axis=1, keepdims=True)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return self.responsibilities(votes)[:, 0]


#: Pseudo-counts (weak priors): of right and wrong votes on good documents, of a
#: kind's own rule on it and of other rules on it; of good documents and of each
#: kind.  Nothing else holds the estimates in place.
ON_GOOD, OWN, OTHER, SHARES = (9.0, 1.0), (9.0, 1.0), (2.0, 2.0), (8.0, 0.25)
#: A kind that fewer documents than this support is left out.
SUPPORT = 0.5
#: Keeps logarithms finite.
TINY = 1e-6


def initial(r: int) -> VoteModel:
    shares = np.array([SHARES[0], *[SHARES[1]] * r])
    return VoteModel(shares / shares.sum(), np.full(r, 0.95), np.where(np.eye(r) > 0, 0.9, 0.3))


def estimate(votes: np.ndarray, counts: np.ndarray, rounds: int = 500, tolerance: float = 1e-9) -> VoteModel:
    """Expectation-maximisation over vote patterns and their counts.  It starts
    with a kind of bad documents for each rule; kinds that no documents support
    are left out, and the others are estimated further."""
    r = votes.shape[1]
    model, kinds = initial(r), np.arange(r)
    plus, minus = (votes > 0) * counts[:, None], (votes < 0) * counts[:, None]
    for _ in range(rounds):
        own = kinds[:, None] == np.arange(r)
        right, wrong = (np.where(own, OWN[i], OTHER[i]) for i in (0, 1))
        p = model.responsibilities(votes)
        mass = p.T @ counts
        shares = mass + np.array([SHARES[0], *[SHARES[1]] * len(kinds)])
        up, down = p.T @ plus, p.T @ minus
        good = (up[0] + ON_GOOD[0]) / (up[0] + down[0] + sum(ON_GOOD))
        bad = (down[1:] + right) / (up[1:] + down[1:] + right + wrong)
        new = VoteModel(shares / shares.sum(), np.clip(good, TINY, 1 - TINY), np.clip(bad, TINY, 1 - TINY))
        moved = max(np.abs(x - y).max(initial=0) for x, y in ((new.shares, model.shares), (new.good, model.good), (new.bad, model.bad)))
        model = new
        if moved < tolerance:
            held = mass[1:] >= SUPPORT
            if held.all():
                break
            kinds = kinds[held]
            shares = model.shares[np.concatenate(([True], held))]
            model = VoteModel(shares / shares.sum(), model.good, model.bad[held])
    return model


def scored(docs: DataFrame, keep: list[str], threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``keep``, the statistics, base_failed, posterior and kept of every row.

    base_failed: fewer than 50 words, or more than half of the words in
    repeated 3-word windows.  kept: not base_failed and posterior of at least
    ``threshold``.  Null and empty texts have no words and so fail; very long
    texts are read whole; rows that repeat get the same verdict each; an empty
    table gives an empty result.  ``keep`` must not name a statistic.
    """
    spark = docs.sparkSession
    voters = rules()
    stats = statistics(docs, keep, text_col)
    stats = materialise(stats.withColumns({f"vote_{n}": v.cast("byte") for n, v in voters.items()}), "rules")
    names = [f"vote_{n}" for n in voters]
    # At most 3 ** len(rules) rows, whatever the input's size.
    found = stats.groupBy(*names).count().collect()
    patterns = np.array([[r[n] for n in names] for r in found], np.int64).reshape(len(found), len(names))
    model = estimate(patterns, np.array([r["count"] for r in found], np.float64)) if found else initial(len(names))
    posterior = model.posterior(patterns) if found else np.empty(0)
    table = spark.createDataFrame([(*map(int, v), float(p)) for v, p in zip(patterns, posterior)], ", ".join(f"{n} byte" for n in names) + ", posterior double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        stats.join(F.broadcast(table), names)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))
    )


def kept_rows(docs: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns, which
    may have any names.  Rows go through the statistics' pass whole, so no join
    is needed to pick them."""
    inner = {c: f"__{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(c).alias(n) for c, n in inner.items()])
    out = scored(renamed, list(inner.values()), threshold, inner[text_col]).filter("kept")
    return out.select(*[F.col(n).alias(c) for c, n in inner.items()])


def quality_rules(docs: DataFrame) -> DataFrame:
    """(doc_id, the base counts, base_failed, kept, posterior); see scored."""
    return scored(docs, ["doc_id"]).select("doc_id", *COUNTS, "base_failed", "kept", "posterior")
