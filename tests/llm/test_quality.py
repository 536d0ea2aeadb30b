import random
import re
from collections import Counter

import numpy as np
import pytest
from rankspark.llm import quality as Q

from .conftest import ODD, plain


def base(text):
    words, text = plain(text), text or ""
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if plain(line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = len({k for i, w in enumerate(windows) if count[w] > 1 for k in range(i, i + 8)})
    n = len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, words)), symbols, repeated, covered, n < 20 or 100 * covered > 30 * n


def vectors(rows):
    """Of (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    n, chars, symbols, lines, words = np.array([r[:5] for r in rows], float).T
    n, chars = np.maximum(n, 1), np.maximum(chars, 1)
    columns = np.log(chars / n), np.log1p(100 * symbols / n), np.log1p(lines), np.arcsin(np.sqrt(words / n))
    return np.stack([np.floor(1024 * c + 0.5) for c in columns], 1) / 1024


NOISE = np.diag(np.array(Q.NOISE) ** 2)


def squared(x, mean, covariance):
    return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(covariance), x - mean)


def estimate(rows, share=None):
    return rows.mean(0), NOISE + (Q._consistency(share) if share else 1) * np.cov(rows.T, bias=True).reshape(4, 4)


def robust(x):
    """The reweighted estimate of one group and its size, by whole sorts of classes."""

    def median(v):
        return np.sort(v)[-(-len(v) // 2) - 1]

    mean = np.array([median(c) for c in x.T])
    spread = np.diag([(1.4826 * median(np.abs(c - m))) ** 2 for c, m in zip(x.T, mean, strict=True)])
    best = np.inf, None
    for now in ((mean, NOISE + spread), (mean, NOISE), estimate(x)):
        det = np.inf
        while True:
            classes = np.floor(256 * np.log1p(squared(x, *now)))
            most = np.sort(classes)[int(np.ceil(Q.SHARE * len(x))) - 1]
            now, before = estimate(x[classes <= most], Q.SHARE), det
            det = np.linalg.slogdet(now[1])[1]
            best = min(best, (det, now), key=lambda e: e[0])
            if not before - det > Q._LEAST_GAIN:
                break
    near = x[squared(x, *best[1]) <= Q.chi2_quantile(Q.REWEIGHT)]
    return (*estimate(near, Q.REWEIGHT), len(near))


def verdict(rows):
    """{key: (distance, kept)} of (key, lang, source, text)."""
    stats = {key: base(text) for key, _, _, text in rows}
    groups, languages = {}, {}
    for key, lang, source, _ in rows:
        if not stats[key][5]:
            groups.setdefault((lang, source), []).append(key)
            languages.setdefault(lang, []).append(key)
    whole = {lang: robust(vectors([stats[k] for k in keys])) for lang, keys in languages.items()}
    out = {key: (None, False) for key in stats}
    for (lang, _), keys in groups.items():
        x = vectors([stats[k] for k in keys])
        mean, own, n = robust(x)
        mixed = (n * own + Q.PRIOR_TEXTS * whole[lang][1]) / (n + Q.PRIOR_TEXTS)
        for key, d in zip(keys, squared(x, mean, mixed), strict=True):
            out[key] = d, d <= Q.chi2_quantile(Q.CUTOFF)
    return out


def corpus(seed, n):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randrange(5, 60))]
        if i % 15 == 0:
            words = [w + rng.choice(["***", "%%%", "|||"]) for w in words]
        if i % 11 == 0:
            words += words[: len(words) // 2]
        lines = " ".join(words).replace(" a", "\na")
        rows.append((i, rng.choice(["en", "de", None]), rng.choice(["a", "a", "b", None]), lines))
    return rows


def test_base_statistics(odd):
    rows = Q.with_statistics(odd).collect()
    found = sorted((str(r.doc_id), tuple(r[c] for c in Q.BASE)) for r in rows)
    assert found == sorted((str(i), base(t)) for i, t in ODD)


@pytest.mark.parametrize(("seed", "n"), [(1, 600), (2, 300), (3, 40)])
def test_robust_distances_against_numpy(spark, seed, n):
    rows = corpus(seed, n)
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    wanted = verdict(rows)
    for r in Q.verdicts(df).collect():
        d, kept = wanted[r.doc_id]
        assert r.kept == kept
        assert r.distance2 == (None if d is None else pytest.approx(d, rel=1e-6))
    symbols = [k for k, _, _, t in rows if re.search(r"[*%|]", t) and wanted[k][0] is not None]
    if n > 100:
        assert not any(wanted[k][1] for k in symbols)


def test_groups_of_any_size(spark):
    """Groups of 20, 99, 100 and 101 texts are judged by one rule, and none is rejected as a whole."""
    rng = random.Random(9)
    rows = []
    for source, n in (("a", 20), ("b", 99), ("c", 100), ("d", 101), ("e", 1)):
        longest = 4 + len(rows) % 5  # words of another length in each source
        for _ in range(n):
            words = ["".join(rng.choices("abcdefgh", k=rng.randint(2, longest))) for _ in range(rng.randint(30, 60))]
            rows.append((len(rows), "en", source, " ".join(words)))
    rows += [(1000 + i, "en", "cd"[i % 2], " ".join(["*#$%" * 5] * 3 + [f"word{k}" for k in range(30)])) for i in range(4)]
    found = Q.verdicts(spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")).collect()
    wanted = verdict(rows)
    for r in found:
        assert (r.kept, r.distance2) == (wanted[r.doc_id][1], pytest.approx(wanted[r.doc_id][0], rel=1e-6))
    assert all(r.kept == (r.doc_id < 1000) for r in found)


def test_keeping_leaves_rows_as_they_are(spark, odd, nothing):
    kept = Q.keep(odd)
    assert kept.schema == odd.schema
    rows = {tuple(r) for r in odd.collect()}
    left = kept.collect()
    assert left and all(tuple(r) in rows and not base(r.text)[5] for r in left)
    assert Q.verdicts(odd).count() == len(ODD)
    assert Q.verdicts(nothing).count() == Q.keep(nothing).count() == 0


def test_chi2():
    assert Q.chi2_quantile(0.975) == pytest.approx(11.1433, abs=1e-3)
    assert Q._consistency(0.75) == pytest.approx(1.4864, abs=1e-3)
