"""The labellers' error rates and posteriors, against simulated labellers and a plain EM."""

import math
import random

import pytest

from dayloom.llm import weak_label

N = len(weak_label.LABELLERS)


def cast(false_alarms, seed, n=8000):
    """(good, votes) of simulated documents: a fifth is junk, seen by the labellers of its one or two kinds."""
    rng, found = random.Random(seed), []
    for _ in range(n):
        bad = set(rng.sample(range(N), rng.choice([1, 2, 2]))) if rng.random() < 0.2 else set()
        found.append((not bad, "".join(
            "0" if rng.random() < 0.1 else "-" if rng.random() < (0.9 if k in bad else false_alarms[k]) else "+" for k in range(N))))
    return found


def counted(votes):
    found = {}
    for v in votes:
        found[v] = found.get(v, 0) + 1
    return found


def plain_em(patterns, rounds):
    """The same model document class by document class, vote by vote."""
    good = {v: (v.count("+") + 0.5) / (v.count("+") + v.count("-") + 1) for v in patterns}
    for _ in range(rounds):
        sizes, rates = [], []
        for c in (0, 1):
            mass = {v: n * (good[v] if c else 1 - good[v]) for v, n in patterns.items()}
            sizes.append(sum(mass.values()) + weak_label.PRIOR)
            seen = [{s: weak_label.PRIOR + sum(m for v, m in mass.items() if v[k] == s) for s in "+-0"} for k in range(N)]
            rates.append([{s: x / sum(one.values()) for s, x in one.items()} for one in seen])
        for v in patterns:
            a, b = (math.log(sizes[c] / sum(sizes)) + sum(math.log(rates[c][k][s]) for k, s in enumerate(v) if s != ".") for c in (0, 1))
            good[v] = 1 / (1 + math.exp(min(700, a - b)))
    return good, rates


@pytest.mark.parametrize("seed", [5, 6, 7])
def test_false_alarms_are_estimated(seed):
    alarms = [0.02, 0.05, 0.15] + [0.004] * (N - 3)
    docs = cast(alarms, seed)
    _, rates, posterior = weak_label.fit_labellers(counted(v for _, v in docs))
    assert all(abs(1 - rates[k][1] - a) < 0.03 for k, a in enumerate(alarms))
    lone = {k: posterior["+" * k + "-" + "+" * (N - k - 1)] for k in range(N)}
    assert lone[2] > 0.5  # the worst labeller alone rejects nothing
    assert all(lone[k] < 0.5 for k in range(3, N))  # those who are hardly ever wrong do
    assert all(posterior[v] > 0.5 for _, v in docs if "-" not in v)


def test_one_bad_labeller_is_overruled():
    docs = cast([0.004] * (N - 1) + [0.15], 5)
    _, rates, posterior = weak_label.fit_labellers(counted(v for _, v in docs))
    assert abs(1 - rates[N - 1][1] - 0.15) < 0.03
    alone = [g for g, v in docs if v[-1] == "-" and "-" not in v[:-1] and "0" not in v]
    assert sum(alone) > 0.8 * len(alone) > 0 and posterior["+" * (N - 1) + "-"] > 0.5


def test_em_equals_a_plain_one():
    docs = [v for _, v in cast([0.05] * N, 9, 400)] + ["+-" + "." * (N - 2), "++" + "." * (N - 2)] * 9
    patterns = counted(docs)
    for rounds in (1, 12):
        _, rates, found = weak_label.fit_labellers(patterns, rounds)
        good, plain = plain_em(patterns, rounds)
        assert found == pytest.approx(good, abs=1e-9)
        for c in (0, 1):
            assert [r[c] for r in rates] == pytest.approx([one["+"] / (one["+"] + one["-"]) for one in plain[c]], abs=1e-9)


def test_no_votes_and_one_pattern():
    assert weak_label.fit_labellers({})[2] == {}
    assert weak_label.fit_labellers({"+" * N: 3})[2]["+" * N] > 0.5
    assert weak_label.votes("") == weak_label.votes(None) == "." * N
    assert weak_label.votes("a few words") == "++" + "." * (N - 2)


def test_shapes_cover_whole_words():
    assert weak_label.shape(b"Ab12-xy") == b"Aa0-a"
    long = b"ab" * 50 + b"-1" * 40
    assert weak_label.shape(long) == b"a" + b"-0" * 40
    assert weak_label.shape(long + b"Z") != weak_label.shape(long)
