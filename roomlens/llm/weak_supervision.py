"""Quality rules that vote or abstain, weighed by expectation maximisation over all documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from roomlens.llm.common import read_slices
from roomlens.sources.scratch import shared_table

MIN_WORDS = 10
MAX_REPEAT_PCT = 20
WINDOW = 5
KEEP_FROM = 0.5  # posterior probability of quality
STEPS, TOLERANCE = 500, 1e-9

_BLANKS = r"[\x20\x09-\x0D]+"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
COUNTS = (*BASE, "n_lines", "n_ended_lines", "n_upper", "n_marks", "n_runs", "n_stutters", "n_distinct", "n_bare")

#: Rule: (condition of a good vote, condition of a bad vote), over the counts; abstains where neither holds.
#: Every share has a gap between the two, in which the rule does not know.
RULES: dict[str, tuple[str, str]] = {
    "symbols": ("100 * n_symbols <= n_words", "100 * n_symbols > 10 * n_words"),
    "repeated_windows": ("100 * n_repeat_words <= 2 * n_words", "100 * n_repeat_words > 10 * n_words"),
    "repeated_lines": ("n_lines >= 4 AND n_dup_lines = 0", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    "word_length": ("word_chars BETWEEN 3 * n_words AND 10 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    "capitals": ("100 * n_upper <= 15 * word_chars", "100 * n_upper > 40 * word_chars"),
    "shouting": ("100 * n_marks <= 5 * n_words", "100 * n_marks > 25 * n_words"),
    "punctuation_runs": ("100 * n_runs <= n_words", "100 * n_runs > 10 * n_words"),
    "stutter": ("100 * n_stutters <= 2 * n_words", "100 * n_stutters > 10 * n_words"),
    "sentence_ends": ("100 * n_ended_lines >= 60 * n_lines", "100 * n_ended_lines < 10 * n_lines"),
    "bare_words": ("100 * n_bare <= 2 * n_words", "100 * n_bare > 10 * n_words"),
    "vocabulary": ("n_words < 200 AND 2 * n_distinct >= n_words", "n_words < 200 AND 4 * n_distinct < n_words"),
}
GOOD, BAD, ABSTAIN = 0, 1, 2
_START = {GOOD: (0.8, 0.4), BAD: (0.02, 0.4), ABSTAIN: (0.18, 0.2)}  # of a rule, given quality and given none


def _ranks(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers of the pairs (left, right), equal for equal pairs."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def _per_text(mask: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of[mask], minlength=n)


def counts(texts: pa.Array) -> list[np.ndarray]:
    """The ``COUNTS`` of each text, all texts at once; words and windows are compared exactly."""
    n = len(texts)
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    pieces = pc.split_pattern_regex(texts, _BLANKS)
    of = pc.list_parent_indices(pieces).to_numpy()
    words = pc.list_flatten(pieces)
    some = pc.not_equal(words, "")
    words, of = words.filter(some), of[some.to_numpy(zero_copy_only=False)]
    word = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    same_text = of[1:] == of[:-1]
    stutter = np.r_[False, same_text & (word[1:] == word[:-1])] if len(of) else np.zeros(0, bool)
    covered = np.zeros(len(of), dtype=bool)
    if len(of) >= WINDOW:
        two = _ranks(word[:-1], word[1:])
        four = _ranks(two[:-2], two[2:])
        five = _ranks(four[:-1], word[4:])
        whole = of[4:] == of[:-4]  # the window lies in one text
        five = _ranks(five, of[4:])
        often = (np.bincount(five[whole], minlength=int(five.max()) + 1) > 1)[five] & whole
        for step in range(WINDOW):
            covered[step : step + len(often)] |= often
    lines = pc.split_pattern(texts, "\n")
    line_of = pc.list_parent_indices(lines).to_numpy()
    line = pc.list_flatten(lines)
    spoken = pc.match_substring_regex(line, r"[^\x20\x09-\x0D]")
    line, line_of = line.filter(spoken), line_of[spoken.to_numpy(zero_copy_only=False)]
    ended = pc.match_substring_regex(line, r"[.!?…。！？][\"')\]»”]*[\x20\x09-\x0D]*$").to_numpy(zero_copy_only=False)
    kind = line.dictionary_encode().indices.to_numpy().astype(np.int64)
    firsts = np.unique(_ranks(kind, line_of), return_index=True)[1]
    distinct = np.unique(_ranks(word, of), return_index=True)[1]
    n_words, n_lines = np.bincount(of, minlength=n), np.bincount(line_of, minlength=n)

    def matches(pattern: str) -> np.ndarray:
        return pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False)

    return [
        n_words,
        np.bincount(of, weights=pc.utf8_length(words).to_numpy(), minlength=n),
        matches(r"[#*$%&|<>]"),
        n_lines - np.bincount(line_of[firsts], minlength=n),
        _per_text(covered, of, n),
        n_lines,
        _per_text(ended, line_of, n),
        matches(r"\p{Lu}"),
        matches(r"[!?]"),
        matches(r"!!+|\?\?+|##+|\*\*+|\$\$+|%%+|&&+|\|\|+|==+|~~+|__+|\.\.\.\.+"),
        _per_text(stutter, of, n),
        np.bincount(of[distinct], minlength=n),
        _per_text(pc.match_substring_regex(words, r"^[^\p{L}\p{N}]+$").to_numpy(zero_copy_only=False), of, n),
    ]


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, counts) of every row of ``docs``."""
    rows = docs.select("doc_id", F.col("text").cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in read_slices(batches, "text"):
            columns = [pa.array(c.astype(np.int64)) for c in counts(batch["text"])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *COUNTS])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, " + ", ".join(f"{c} long" for c in COUNTS))


def pattern(rules: dict[str, tuple[str, str]] = RULES) -> F.Column:
    """One number for the votes of all rules: a digit to the base of three for each."""
    votes = [
        f"CASE WHEN n_words = 0 THEN {ABSTAIN} WHEN {good} THEN {GOOD} WHEN {bad} THEN {BAD} ELSE {ABSTAIN} END * {3 ** n}L"
        for n, (good, bad) in enumerate(rules.values())
    ]
    return F.expr(" + ".join(votes))


def _digits(patterns: np.ndarray, rules: int) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(rules) % 3


def estimate(patterns: np.ndarray, numbers: np.ndarray, rules: int = len(RULES)) -> np.ndarray:
    """Posterior probability of quality of each pattern of votes, from how often each occurs.

    Documents are a mixture of two kinds, in which rules vote independently; a rule has three chances
    (good, bad, abstain) in each kind, which are its accuracies. They are fitted by expectation
    maximisation from a start in which rules are better than guessing; a pseudo-count of one half keeps
    each chance above zero.
    """
    if not len(patterns):
        return np.zeros(0)
    votes = _digits(patterns, rules)[:, :, None] == np.array([GOOD, BAD, ABSTAIN])  # pattern, rule, vote
    chance = np.array([[_START[v][kind] for v in (GOOD, BAD, ABSTAIN)] for kind in (0, 1)])
    chance = np.repeat(chance[:, None, :], rules, axis=1)  # kind, rule, vote
    prior, before = 0.7, -np.inf
    for _ in range(STEPS):
        logs = np.einsum("prv,krv->kp", votes, np.log(chance)) + np.log([prior, 1 - prior])[:, None]
        total = np.logaddexp(*logs)
        share = np.exp(logs - total)
        weight = share * numbers
        likelihood = float((total * numbers).sum() / numbers.sum())
        held = np.einsum("kp,prv->krv", weight, votes) + 0.5
        chance = held / held.sum(axis=2, keepdims=True)
        prior = (weight[0].sum() + 1) / (numbers.sum() + 2)
        if likelihood - before < TOLERANCE:
            break
        before = likelihood
    return share[0]


def judge(docs: DataFrame, keep_from: float = KEEP_FROM) -> DataFrame:
    """(doc_id, counts, votes, quality, base_failed, kept) of every row of ``docs`` (doc_id, text).

    ``votes`` numbers the pattern of the rules' votes, ``quality`` is the posterior probability of that
    pattern over all documents that pass the base rules; base_failed: fewer than ``MIN_WORDS`` words, or
    more than ``MAX_REPEAT_PCT`` percent of the words in repeated windows of five. ``kept``: the base
    passes and quality reaches ``keep_from``. Only the patterns' frequencies reach the driver, 3 to the
    power of the number of rules at most. Null and empty texts have no words and fail the base; repeated
    rows are judged alike and count as often as they stand; a text of any length is read whole; no rows
    give no rows; other columns are ignored.
    """
    failed = f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words"
    voted = shared_table(
        measured(docs).withColumns({"votes": pattern(), "base_failed": F.expr(failed)}), "quality-votes"
    )
    found = voted.where("NOT base_failed").groupBy("votes").agg(F.count(F.lit(1)).alias("n")).orderBy("votes").collect()
    patterns, numbers = (np.array([r[i] for r in found], dtype=np.int64) for i in (0, 1))
    posterior = estimate(patterns, numbers.astype(float))
    known = docs.sparkSession.createDataFrame(
        list(zip(patterns.tolist(), posterior.tolist())), "votes long, quality double"
    )
    judged = voted.join(F.broadcast(known), "votes", "left")
    kept = F.expr(f"NOT base_failed AND coalesce(quality >= {keep_from}, false)")
    return judged.select("doc_id", *COUNTS, "votes", "quality", "base_failed", kept.alias("kept"))
