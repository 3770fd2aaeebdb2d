"""Licences that are no line of their own: inside a line, wrapped, as a file header, as a full text."""

import random

import pytest

from textprice.llm import licenses
from textprice.llm.queries import QUERIES

from .test_text_operators import frame, prose

TEXTS = {n: t for n, t in licenses.FULL_TEXTS if len(t) > 1000}
HEADERS = {n: t for n, t in licenses.FULL_TEXTS if len(t) < 1000}


def test_planted_licenses_are_found_by_the_query(spark, tmp_path):
    rng = random.Random(3)
    around = lambda n=60: " ".join(prose(rng, n))
    notice = dict(licenses.TEMPLATES)["GPL-2.0"]
    wrapped = notice.replace("the GNU", "the\nGNU").replace("License,", "License,\n")
    comment = "\n".join(f"# {x.strip()}" for x in HEADERS["Apache-2.0"].split("\n"))
    dashes = "\n".join(f"-- {x.strip()}" for x in HEADERS["GPL-3.0"].split("\n"))
    mit = TEXTS["MIT"].replace("Copyright (c)", "Copyright (c) 2001 Some Person")
    one_line = " ".join(TEXTS["BSD-2-Clause"].split())
    cases = [(f"{around()} {notice} {around()}", "GPL-2.0"), (f"{around()}\n{wrapped}\n{around()}", "GPL-2.0"),
             (f"{comment}\n{around()}", "Apache-2.0"), (f"{dashes}\n{around()}", "GPL-3.0"), (f"{around()}\n{mit}\n{around()}", "MIT"),
             (f"{around()} {one_line} {around()}", "BSD-2-Clause"), (around(400), None), (None, None), ("", None)]
    cases += [(f"{around()}\n{TEXTS[n]}\n{around()}", n) for n in ("Apache-2.0", "BSD-3-Clause", "GPL-3.0", "MPL-2.0")]
    spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op8_license_scan"](spark, str(tmp_path)).collect()}
    assert [rows[i]["license"] for i in range(len(cases))] == [n for _, n in cases]
    assert rows[0]["license_score"] == 1.0 and rows[0]["n_license_lines"] == 0


@pytest.mark.parametrize("threshold", [0.6, 0.8])
def test_spans_brute_force(spark, threshold):
    rng = random.Random(5)
    templates = [(f"t{i}", " ".join(prose(rng, n, 12))) for i, n in enumerate((3, 5, 6, 8, 9, 1))]
    texts = []
    for _ in range(60):
        words = prose(rng, rng.randrange(0, 40), 12)
        own = rng.choice(templates)[1].split()
        if rng.random() < 0.7:
            own[rng.randrange(len(own))] = "x"
        at = rng.randrange(len(words) + 1)
        words[at:at] = own
        texts.append("".join(w + rng.choice([" ", "\n", " -- "]) for w in words))
    rows = {r["doc_id"]: r for r in licenses.scan_licenses(frame(spark, texts), templates=templates, threshold=threshold, spans=True).collect()}
    for i, t in enumerate(texts):
        words = licenses.spoken(licenses.words_of(t))
        best = 0.0
        for _, body in templates:
            own, n = licenses.bigrams_of(licenses.words_of(body)), len(body.split()) - 1
            widest = int(n * (2 - threshold) / threshold + 1e-9)
            for a in range(len(words)):
                for b in range(a + 1, min(a + widest + 1, len(words)) + 1):
                    span = licenses.bigrams_of(words[a:b])
                    best = max(best, 2 * len(span & own) / (len(span) + len(own)))
        got = rows[i]["license_score"]
        assert got == best if best >= threshold else got is None or got >= threshold, (t, got, best)
