import textwrap

import pytest
from rankspark.llm import licenses as L

from .conftest import ODD, alnum


def dice(a, b):
    a, b = set(zip(a, a[1:], strict=False)), set(zip(b, b[1:], strict=False))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0


def wanted(text, templates, least):
    units = [(0, text or ""), *enumerate((text or "").split("\n"), 1)]
    found = [(-dice(alnum(u), alnum(t)), k, name) for k, u in units for name, t in templates.items()]
    found = sorted(f for f in found if -f[0] >= least)
    return (found[0][2], -found[0][0], found[0][1], len(found)) if found else (None, None, None, 0)


DOCS = [
    *[t for _, t in ODD],
    "Released under the MIT License.",
    "intro\nReleased under the  mit-license!\n\nReleased under the MIT License, too\n",
    "\nThis work is licensed under the GNU General Public License, version 3.\nThis work is licensed under the GNU General Public License, version 2.",
    "This work is licensed under the GNU Lesser General Public License, version 3",
    "\n".join(L.TEMPLATES.values()),
    "license " * 50,
]


@pytest.mark.parametrize("least", [0.3, 0.8, 1.0])
def test_against_all_pairs(spark, least):
    rows = [(i, t, "x", "y") for i, t in enumerate(DOCS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, license string, line string")
    found = {r.doc_id: r for r in L.scan(df, dice=least).collect()}
    assert len(found) == len(DOCS)
    for i, text in enumerate(DOCS):
        license, value, line, n = wanted(text, L.TEMPLATES, least)
        r = found[i]
        assert (r.license, r.line, r.n_matches) == (license, line, n)
        assert r.dice == (None if value is None else pytest.approx(value))


def test_nothing_and_wrong_parameters(spark, nothing, monkeypatch):
    assert L.scan(nothing).count() == 0
    for options in ({"dice": 0}, {"dice": 1.1}, {"templates": {}}):
        with pytest.raises(ValueError):
            L.scan(nothing, **options)
    monkeypatch.setattr(L, "TEMPLATE_WORDS", 10)
    with pytest.raises(ValueError, match="templates"):
        L.scan(nothing)


def closest(text, template):
    """Over all runs of words of a text."""
    w, t = alnum(text), alnum(template)
    return max((dice(w[i:j], t) for i in range(len(w)) for j in range(i + 2, min(len(w), i + 2 * len(t)) + 1)), default=0)


@pytest.mark.parametrize("name", sorted(L.TEMPLATES))
@pytest.mark.parametrize("form", ["wrapped", "comment", "paragraph", "changed"])
def test_licences_within_longer_texts(spark, name, form):
    text = L.TEMPLATES[name]
    before, after = "int main of a program\nwith more lines " * 8, " and then other words follow here " * 8
    lines = textwrap.wrap(text, 75)
    body = {
        "wrapped": "\n" + "\n".join(lines) + "\n",
        "comment": "\n" + "".join(f" * {x}\n" for x in lines),
        "paragraph": " " + text + " ",
        "changed": "\n" + "\n".join([*lines[:-1], "some " + lines[-1]]) + "\n",
    }[form]
    whole = before + body + after
    (r,) = L.scan(spark.createDataFrame([(1, whole)], "doc_id long, text string")).collect()
    best = max((closest(whole, t), -k, n) for k, (n, t) in enumerate(sorted(L.TEMPLATES.items())))
    assert r.dice == pytest.approx(best[0]) if best[0] >= L.DICE else r.dice is None
    if form != "changed":
        assert (r.license, r.dice) == (name, 1.0)
        assert r.line == whole[: whole.index(text[:10])].count("\n") + 1


def test_passages_do_not_leave_their_text(spark):
    words = L.TEMPLATES["MIT-text"].split()
    rows = [(k, " ".join(words[k::2] if k < 2 else words[30 * (k - 2) : 30 * (k - 1)])) for k in range(4)]
    found = L.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert [r.license for r in sorted(found)] == [None] * 4
