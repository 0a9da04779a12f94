"""License scans against the plain way."""
from __future__ import annotations

import random
import re

from helpers import SCHEMA, awkward, awkward_rows, empty
from martkit.llm import licences


def _words(text):
    return re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text):
    w = _words(text)
    places = sorted((i, k) for k, p in licences.PHRASES.items() for i in range(len(w) - len(p) + 1) if tuple(w[i:i + len(p)]) == p)
    met = {}
    for at in range(0, max(0, -(-(len(w) - licences.BLOCK) // licences.STEP)) * licences.STEP + 1, licences.STEP):
        block = set(w[at:at + licences.BLOCK])
        for k, t in licences.TEMPLATES.items():
            own = set(t.split())
            share = len(own & block) / len(own)
            if share >= licences.LEAST - 1e-9:
                met[k] = max(share, met.get(k, 0))
    base = {k for _, k in places}
    return (len(w), len(places), places[0][0] if places else None, places[-1][0] if places else None, ",".join(sorted(base)),
            ",".join(sorted(base | set(met))), 1.0 if places else max(met.values(), default=0.0))


def check(docs, texts):
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licences.license_labels(docs).collect())
    assert got == sorted((str(i), *plain(t)) for i, t in texts)
    return got


def test_labels(spark):
    rng = random.Random(8)
    common = "the of and to in is this work software any version under license free".split()
    texts = []
    for i in range(150):
        words = rng.choices(common, k=rng.choice([0, 5, 40, 200]))
        for _ in range(rng.randrange(3)):
            t = rng.choice([*licences.TEMPLATES.values(), "MIT-License", "the Apache (license)", "GNU General Public\nLicense"]).split()
            t = [x for x in t if rng.random() < rng.choice([1, 1, 0.85])]
            at = rng.randrange(len(words) + 1)
            words[at:at] = [rng.choice([x, x.upper(), x + ","]) for x in t]
        texts.append((i, " ".join(words)))
    got = check(spark.createDataFrame([(i, t, "en", "s", 1) for i, t in texts], SCHEMA), texts)
    assert sum("cc-by" in g[6] for g in got) and sum("mit" == g[5] for g in got)


def test_awkward_and_empty(spark):
    check(awkward(spark), [(r[0], r[1]) for r in awkward_rows()])
    assert licences.license_labels(empty(spark)).count() == 0
    texts = [(1, "Mit License"), (1, "Mit License"), (None, "...mit...LICENSE..."), (2, "İ MIT LİCENSE mit\xa0license"), (3, "general public license " * 5000)]
    check(spark.createDataFrame([(i, t, "", "", 1) for i, t in texts], SCHEMA), texts)
