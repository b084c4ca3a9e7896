"""License scans by their method: bands retrieve, whole licence texts are found, results equal a scan of every window."""

import random
import re

import pytest

from loanflow.llm import licenses
from loanflow.llm.licenses import CONTAINMENT, LICENSE_TEXTS, NOTICES, SECTION, TEMPLATES, step_of


def words(text):
    return re.findall(licenses.WORD, text.lower())


def runs(w):
    return [" ".join(w[i:i + 5]) for i in range(len(w) - 4)]


def scan(text, notices=TEMPLATES):
    """Every template of one section, in every window, without bands: {template: best containment}."""
    seen, out = runs(words(text)), {}
    for k, (_, notice) in enumerate(notices):
        own = runs(words(notice))
        if len(own) > SECTION:
            continue
        step = step_of(len(own))
        for at in range(0, len(seen), step):
            share = len(set(own) & set(seen[at:at + len(own) + step - 1])) / len(set(own))
            if share >= CONTAINMENT:
                out[k] = max(out.get(k, 0), share)
    return out


def run(spark, texts, notices=TEMPLATES):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return licenses.scan_licenses(df, notices).collect()


def edited(rng, text, share):
    """A text with about ``share`` of its words replaced, all in one run somewhere."""
    w = text.split()
    n = round(len(w) * share)
    at = rng.randrange(len(w) - n + 1)
    return " ".join(w[:at] + ["changed"] * n + w[at + n:])


def test_equals_scan_of_all_windows(spark):
    rng = random.Random(4)
    texts = []
    for k in range(120):
        parts = [edited(rng, rng.choice(NOTICES)[1], rng.choice([0, 0, 0.1, 0.2, 0.4])) for _ in range(rng.randrange(1, 5))]
        texts.append(" ".join(x for p in parts for x in (p, *["filler"] * rng.choice([0, 1, 3, 40]))))
    got = {}
    for r in run(spark, texts, NOTICES):
        got.setdefault(r["doc_id"], {})[r["template"]] = r["containment"]
    assert got == {k: scan(t, NOTICES) for k, t in enumerate(texts) if scan(t, NOTICES)}


def test_whole_licence_texts(spark):
    first = len(NOTICES)
    assert all(len(runs(words(t))) > SECTION for _, t in LICENSE_TEXTS)
    texts = []
    for k, (_, t) in enumerate(LICENSE_TEXTS):
        w = t.split()
        texts += [" ".join(["before"] * 7 * (k + 1)) + " " + t + " after" * 90,  # whole
                  " ".join(w[:len(w) * 9 // 10]), " ".join(w[len(w) // 8:]),  # cut at an end, still held to 0.75
                  " ".join(w[:len(w) // 2]), " ".join(w[::-1])]  # half, and backwards: not held
    got = {(r["doc_id"], r["template"]): r for r in run(spark, texts) if r["template"] >= first}
    for k in range(len(LICENSE_TEXTS)):
        assert got[5 * k, first + k]["containment"] == 1.0
        for j in (1, 2):
            own = set(runs(words(LICENSE_TEXTS[k][1])))
            assert got[5 * k + j, first + k]["containment"] == pytest.approx(len(own & set(runs(words(texts[5 * k + j])))) / len(own))
        assert all((5 * k + j, first + k) not in got for j in (3, 4))


def test_long_template_with_changes_in_every_section(spark):
    """No section is whole, the sum of the sections still is enough."""
    notice = " ".join(f"w{k}" for k in range(300))
    w = notice.split()
    for k in (30, 90, 150, 210, 270):
        w[k] = "changed"
    (r,) = run(spark, ["x y z " + " ".join(w)], (("own", notice),))
    assert r["containment"] == pytest.approx((296 - 25) / 296)


def test_very_long_text_of_one_notice(spark):
    text = " ".join([NOTICES[1][1]] * 3000 + [LICENSE_TEXTS[0][1]] * 300)
    got = {r["template"]: r["containment"] for r in run(spark, [text, None, ""])}
    assert got[1] == 1.0 and got[len(NOTICES)] == 1.0 and got[8] == 1.0


def test_bands_retrieve(spark, monkeypatch):
    monkeypatch.setattr(licenses, "BANDS", 0)
    assert run(spark, [t for _, t in TEMPLATES]) == []


def test_many_templates_and_short_ones(spark):
    many = tuple((f"l{k}", " ".join(f"t{k}x{j}" for j in range(6))) for k in range(1100))
    got = run(spark, [many[k][1] + " and more" for k in range(0, 1100, 100)], many)
    assert [(r["doc_id"], r["template"]) for r in sorted(got)] == [(k, 100 * k) for k in range(11)]
    with pytest.raises(ValueError):
        run(spark, ["a"], (("x", "only four words here"),))
