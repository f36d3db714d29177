"""Mixing to target weights by soft domain membership, in DataFrame functions only.

1. A labelled table names the domain of some documents. A naive Bayes classifier
   over hashed words, fitted on a bounded sample of them, gives every document
   its posterior over the domains, in whole hundredths.
2. A document's rate (how often it should be taken) is at least ``least_rate``.
   The rates minimise the squared relative errors of the expected domain token
   totals against the targets, plus a small pull towards a rate of one, by
   projected gradient descent (with momentum). A gradient step depends on a document only
   through its posterior, so documents with equal posteriors share a rate, and
   the steps run over the token totals of the distinct posteriors: a table that
   the hundredths bound (5,151 rows for three domains), whatever the input.
3. A document is taken ``floor(rate)`` times, and once more with the rest of the
   rate as probability, decided by a hash of its id.
"""

from __future__ import annotations

import math
import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidewater.llm.common import column, fresh_names, materialise, stable_sample

#: Labelled documents a domain that the classifier is fitted on, at most.
MAX_LABELLED = 5_000
BUCKETS = 4_096
#: A text's words weigh as much as this many, so posteriors stay soft.
EVIDENCE_WORDS = 30
GRAIN = 100
PULL = 1e-3
#: The descent ends when a projected step moves less than this share of all tokens.
TOLERANCE, MAX_STEPS = 2e-5, 2_000
_STEPS_A_TABLE = 16
_SMOOTH = 0.5


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"\s+"), "")


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int") + 1


def _numbers(values, digits: int = 5) -> Column:
    """A constant array of doubles (folded by the optimizer)."""
    return F.split(F.lit(",".join(f"{v:.{digits}g}" for v in values)), ",").cast("array<double>")


class DomainClassifier:
    """Log priors and log word-bucket probabilities of the domains."""

    def __init__(self, domains: list[str], priors: list[float], weights: list[list[float]]):
        self.domains, self.priors, self.weights = domains, priors, weights

    @classmethod
    def fit(cls, docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id",
            text_col: str = "text", max_labelled: int = MAX_LABELLED) -> DomainClassifier:
        """Fit on at most ``max_labelled`` documents of each domain.

        ``labels`` has the columns ``id`` and ``domain``, one row an id counts
        (the smallest domain); other domains and null ids are left out. Without
        labelled documents all posteriors are equal.
        """
        known = labels.where("id is not null").groupBy("id").agg(F.min("domain").alias("domain"))
        known = known.where(F.col("domain").isin(domains))
        shares = {r.domain: r.n for r in known.groupBy("domain").agg(F.count("*").alias("n")).collect()}
        sample = reduce(DataFrame.union, [
            stable_sample(known.where(F.col("domain") == d), F.col("id"), max_labelled) for d in domains])
        # At most max_labelled rows a domain are broadcast.
        words = (docs.select(column(docs, id_col).alias("id"), _words(column(docs, text_col)).alias("w"))
                 .join(F.broadcast(sample), "id").select("domain", F.explode("w").alias("w")))
        counts = [[0] * BUCKETS for _ in domains]
        for r in words.groupBy("domain", _bucket(F.col("w")).alias("b")).count().collect():  # BUCKETS rows a domain
            counts[domains.index(r.domain)][r.b - 1] = r["count"]
        total = sum(shares.values()) + len(domains) * _SMOOTH
        priors = [math.log((shares.get(d, 0) + _SMOOTH) / total) for d in domains]
        weights = [[math.log((n + _SMOOTH) / (sum(c) + _SMOOTH * BUCKETS)) for n in c] for c in counts]
        return cls(domains, priors, weights)

    def posteriors(self, docs: DataFrame, text_col: str = "text", tokens: str = "tokens",
                   shares: str = "shares") -> DataFrame:
        """``docs`` with ``tokens`` (its words) and ``shares`` (hundredths a domain).

        The shares of all but the first domain are rounded down (but for 1e-9), and the first
        has the rest. A null or empty text has the priors for posteriors.
        """
        b, n, s = fresh_names(docs, "buckets", tokens, "scores")
        out = docs.withColumn(b, F.transform(_words(column(docs, text_col)), _bucket))
        out = out.withColumn(n, F.size(b).cast("bigint"))
        weight = F.least(F.lit(1.0), F.lit(float(EVIDENCE_WORDS)) / F.greatest(F.col(n), F.lit(1)))
        sums = [F.lit(prior) + weight * F.aggregate(b, F.lit(0.0), _adder(self.weights[i], self.weights[0]))
                for i, prior in enumerate(self.priors[1:], 1)]
        out = out.withColumn(s, F.array(F.lit(self.priors[0]), *sums)).drop(b)
        top = F.array_max(s)
        parts = F.transform(s, lambda x: F.exp(x - top))
        total = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
        floors = F.transform(F.slice(parts, 2, len(self.domains)), lambda x: F.floor(GRAIN * x / total + 1e-9).cast("int"))
        out = out.withColumn(s, floors)
        rest = F.lit(GRAIN) - F.aggregate(s, F.lit(0), lambda a, x: a + x)
        return out.withColumn(shares, F.concat(F.array(rest), F.col(s))).drop(s)


def _adder(weights, base):
    ratios = _numbers([w - b for w, b in zip(weights, base)])
    return lambda total, bucket: total + F.element_at(ratios, bucket)


def _descend(steps: list[list[float]], shares: Column, pull: float, least: float) -> Column:
    """A posterior's state after the steps, each a slope per domain and a momentum,
    from its columns ``rate`` and ``ahead``: its rate, the point ``ahead`` of the
    next step, how far the last step moved from its point, and its turn."""
    first = F.struct("rate", "ahead", F.lit(0.0).alias("moved"), F.lit(0.0).alias("turn"))
    if not steps:
        return first
    size, d = 1 / (1 + pull), len(steps[0]) - 1
    wide = F.array(*[_numbers(s, 17) for s in steps])

    def step(state, slope):
        start = state["ahead"]
        push = F.aggregate(F.zip_with(shares, F.slice(slope, 1, d), lambda p, g: p * g), F.lit(0.0),
                           lambda a, x: a + x)
        rate = F.greatest(F.lit(least), start - size * (push / GRAIN + pull * (start - 1)))
        momentum = F.element_at(slope, d + 1)
        return F.struct(rate.alias("rate"), (rate + momentum * (rate - state["rate"])).alias("ahead"),
                        F.abs(rate - start).alias("moved"), ((start - rate) * (rate - state["rate"])).alias("turn"))

    return F.aggregate(wide, first, step)


def fit_rates(posteriors: DataFrame, targets: list[float], budget: float | str = "same", least: float = 0.0,
              pull: float = PULL, tokens: str = "tokens", shares: str = "shares"):
    """``(groups, reached)``: a rate per distinct posterior, and the token share
    of each domain that the rates reach.

    ``targets`` are the domains' shares of ``budget`` tokens: ``"same"`` is the
    input's total, ``"keep"`` the least total at which no domain has to shrink.

    The descent ends when a projected step moves the tokens by ``TOLERANCE`` of all
    at most; a momentum that turns against the step starts anew. If ``MAX_STEPS``
    do not suffice, a warning says so.
    """
    groups = materialise(posteriors.groupBy(shares).agg(F.sum(tokens).alias(tokens)).withColumn(
        "rate", F.greatest(F.lit(1.0), F.lit(least))).withColumn("ahead", F.col("rate")), "posteriors")
    d = range(len(targets))
    steps: list[list[float]] = []

    def sums(at: str) -> list[float]:
        state = groups.withColumn("state", _descend(steps, F.col(shares), pull, least))
        mass = [F.sum(F.col(f"state.{at}") * F.col(tokens) * F.element_at(F.col(shares), i + 1) / GRAIN) for i in d]
        more = [F.sum(F.col(f"state.{x}") * F.col(tokens)) for x in ("moved", "turn")] + [F.sum(tokens)]
        return [x or 0.0 for x in state.agg(*[m.alias(f"t{i}") for i, m in enumerate(mass + more)]).first()]

    *now, _, _, total = sums("ahead")
    have = [x / max(1.0, least) for x in now]
    wanted = [t / sum(targets) for t in targets]
    if budget == "same":
        budget = sum(have)
    elif budget == "keep":
        budget = max([h / w for h, w in zip(have, wanted) if w > 0], default=0.0)
    if not budget:
        return groups.drop("ahead"), wanted
    share = [max(h / budget, 1e-9) for h in have]
    since = 0
    for _ in range(MAX_STEPS):
        # Errors relative to the domain's share at first: the step size 1 / (1 + pull)
        # is then below the inverse of the largest eigenvalue.
        steps.append([(n / budget - w) / s for n, w, s in zip(now, wanted, share)] + [since / (since + 3)])
        *now, moved, turn, total = sums("ahead")
        if moved <= TOLERANCE * total:
            break
        since = 0 if turn > 0 else since + 1
        if len(steps) >= _STEPS_A_TABLE:  # the states so far become columns
            state = groups.withColumn("state", _descend(steps, F.col(shares), pull, least))
            groups = materialise(state.select(shares, tokens, "state.rate", "state.ahead"), "rates")
            steps.clear()
    else:
        warnings.warn(f"the descent moved {moved / total:.2g} of all tokens in its last step", stacklevel=2)
    *now, _, _, _ = sums("rate")
    reached = [n / max(sum(now), 1e-9) for n in now]
    return groups.select(shares, tokens, _descend(steps, F.col(shares), pull, least)["rate"].alias("rate")), reached


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
        text_col: str = "text", budget: float | str = "same", least: float = 0.0) -> DataFrame:
    """The rows of ``mix_and_reached`` alone."""
    return mix_and_reached(docs, labels, targets, id_col, text_col, budget, least)[0]


def mix_and_reached(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
                    text_col: str = "text", budget: float | str = "same",
                    least: float = 0.0) -> tuple[DataFrame, dict[str, float]]:
    """Mixed rows, and the share of the expected tokens that each domain reaches.

    The rows are ``docs`` with ``tokens``, ``shares``, ``rate`` and ``copies`` (new names if taken).

    ``labels`` has the columns ``id`` and ``domain``; ``targets`` maps each domain
    to its wanted share of the expected tokens. Every row comes back, rows taken
    no time with 0 ``copies``. Rows that repeat an id have the same posterior if
    their text is the same, and then the same copies. A null id is hashed too.
    """
    domains = list(targets)
    model = DomainClassifier.fit(docs, labels, domains, id_col, text_col)
    tokens, shares, rate, copies = fresh_names(docs, "tokens", "shares", "rate", "copies")
    rows = materialise(model.posteriors(docs, text_col, tokens, shares), "memberships")
    groups, reached = fit_rates(rows, list(targets.values()), budget, least, tokens=tokens, shares=shares)
    groups = groups.select(shares, F.round("rate", 9).alias(rate))
    draw = F.pmod(F.xxhash64(F.lit("copies"), column(rows, id_col)), F.lit(1 << 30)) / (1 << 30)
    whole = F.floor(rate)
    mixed = rows.join(groups, shares).withColumn(
        copies, (whole + F.when(draw < F.col(rate) - whole, 1).otherwise(0)).cast("int"))
    return mixed, dict(zip(domains, reached))


def take_copies(docs: DataFrame, labels: DataFrame, targets: dict[str, float], id_col: str = "doc_id",
                text_col: str = "text", budget: float | str = "keep", least: float = 1.0) -> DataFrame:
    """``docs`` mixed: each row as often as ``mix`` says, with its columns."""
    mixed = mix(docs, labels, targets, id_col, text_col, budget, least)
    copies = fresh_names(docs, "copies")[0]
    (number,) = fresh_names(mixed, "copy_number")
    taken = mixed.where(F.col(copies) > 0).withColumn(number, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return taken.select(*[column(taken, c) for c in docs.columns])


def label_domains(labels: DataFrame) -> DataFrame:
    """``(id, domain)`` from labels: toxic, else clean or low by quality."""
    return labels.select(
        F.col("doc_id").alias("id"),
        F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "clean")
        .when(F.col("quality") == 0, "low").alias("domain")).where("domain is not null")
