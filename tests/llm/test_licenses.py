import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from readlake.llm import entries
from readlake.llm.licenses import TEMPLATES, scan_licenses

from .helpers import ODD, frame, prose

MIT = next(t.text for t in TEMPLATES if t.label == "mit" and not t.base)
BSD = next(t.text for t in TEMPLATES if t.label == "bsd")
GPL = {n: next(t.text for t in TEMPLATES if t.label == f"gpl-{n}" and t.must != "all") for n in (2, 3)}


def split(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute(text):
    ws = split(text)
    places, labels, score = [], set(), 0.0
    for t in TEMPLATES:
        ts = t.text.split()
        must = ts if t.must == "all" else t.must.split()
        at = next(i for i in range(len(ts)) if ts[i : i + len(must)] == must)
        votes = defaultdict(set)
        for i in range(len(ws) - 2):
            for p in range(len(ts) - 2):
                if ws[i : i + 3] == ts[p : p + 3]:
                    votes[i - p] |= {p, p + 1, p + 2}
        runs = []
        for d in sorted(votes):
            if runs and t.must != "all" and d - runs[-1][1] <= 4:
                runs[-1] = (runs[-1][0], d, runs[-1][2] | votes[d])
            else:
                runs.append((d, d, votes[d]))
        for lo, hi, cov in runs:
            part = len(cov) / len(ts)
            score = max(score, part)
            if part >= 0.75 and 2 * (hi - lo) <= len(ts) and cov >= set(range(at, at + len(must))):
                labels.add(t.label)
        if t.base:
            places += [(i, t.label) for i in range(len(ws)) if ws[i : i + len(ts)] == ts]
    at = [i for i, _ in places]
    base = ",".join(sorted({x for _, x in places}))
    return len(ws), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)), score


def holes(text, k, seed):
    """`text` with some words changed, left out or put in."""
    rnd, ws = random.Random(seed), text.split()
    for _ in range(k):
        i = rnd.randrange(len(ws))
        ws[i : i + rnd.choice([0, 1])] = rnd.choice([["other"], ["new", "words"], []])
    return " ".join(ws)


CASES = [
    "Released under the MIT License.", "under the\tMIT-license; Apache License, Version 2.0 and CC BY-NC 4.0", "CC-BY-NC cc by nc\nby nc", "cc by",
    "under the mit licence", "the apache license version 2", "under the MİT license", "under the mit licenseK", "Éunder the mit license é under the mit license",
    "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June", "gnu general public license version 4", GPL[2].title(), GPL[3], GPL[3].replace("version 3", "version"),
    MIT.upper(), " ".join(MIT.split()[:30]), f"{prose(1, 50)} {MIT} {prose(2, 50)} {BSD}", f"{MIT} {MIT}", "copies of the software " * 9, "0 1 2 under the mit license" * 3,
    *(holes(t, k, s) for s, t in enumerate([MIT, BSD, GPL[2], GPL[3]]) for k in (1, 2, 4, 8)),
]


def test_notices_against_brute_force(spark):
    rows = list(enumerate(CASES)) + [(500 + i, t) for i, (_, t) in enumerate(ODD)] + [(3, CASES[1]), (None, CASES[0]), (None, CASES[0])]
    got = Counter(tuple(r) for r in scan_licenses(frame(spark, rows).repartition(3)).collect())
    assert got == Counter((i, *brute(t)) for i, t in rows)
    labels = {i: r[6] for i, r in {r[0]: r for r in got}.items()}
    assert labels[0] == "mit" and labels[1] == "apache-2,cc-by-nc,mit" and labels[11] == "gpl-2" and labels[12] == "gpl-3" and labels[13] == ""
    assert labels[15] == "" and labels[16] == "bsd,mit"
    assert scan_licenses(frame(spark, rows).limit(0)).collect() == []


def test_very_long_texts_and_a_line_that_all_share(spark):
    long = f"{prose(1, 60_000)} under the mit license " * 3 + "cc by nc " * 20_000
    rows = [(1, long), (2, "")] + [(10 + i, f"{prose(i, 30)} Released under the MIT License. {prose(-i, 30)}") for i in range(2000)]
    got = {r[0]: tuple(r[1:]) for r in scan_licenses(frame(spark, rows)).collect()}
    assert got[1] == (3 * 60_004 + 60_000, 20_003, 60_000, 3 * 60_004 + 3 * 19_999, "cc-by-nc,mit", "cc-by-nc,mit", 1.0)
    assert got[2] == (0, 0, None, None, "", "", 0.0) and all(got[10 + i][:6] == (65, 1, 31, 31, "mit", "mit") for i in range(2000))


@pytest.mark.parametrize("table", ["sf0.001", "sf0.01"])
def test_query_against_brute_force_and_sql(spark, sf, table):
    where = sf.replace("sf0.001", table)
    got = {r[0]: tuple(r[1:]) for r in entries.op13_licenses(spark, where).collect()}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{where}/documents.parquet'")
    assert got == {r[0]: tuple(r[1:]) for r in con.sql(entries.ORACLES["op13_licenses"]).fetchall()}
    if table == sf.rsplit("/", 1)[-1]:
        assert got == {r[0]: brute(r[1]) for r in spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text").collect()}
        assert sum(r[1] for r in got.values())
