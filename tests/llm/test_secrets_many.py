"""Secrets: texts with very many spans, and how owners and repositories decide, against brute force."""

import random
import re

from liftlab.llm import secrets
from tests.llm import data

ASSIGN = re.compile(secrets.ASSIGN)
KEY = "Zx9Qw8Er7Ty6Ui5Op4As3"


def many(n):
    rng = random.Random(n)
    parts = []
    for i in range(n):
        kind = rng.randrange(4)
        parts.append((f"password={i:08d}ab", f"AKIA{i:020d}", f"{i:030x}", f"token: 'é{i:07d}secret=x'")[kind])
    return " \n".join(parts) + " end"


def test_many_spans_are_found_and_masked(spark):
    """More spans than a running sum walks over at a time; single owner, so all are masked."""
    text = many(1500)
    rows = [(1, text, "en", "a", len(text)) + ("x",) * data.EXTRA, (2, "no secret", "en", "b", 9) + ("x",) * data.EXTRA]
    docs = data.frame(spark, rows)
    spans = {("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= secrets.ASSIGN_LEAST}
    spans |= {("access", m.start(), m.end()) for m in re.finditer(secrets.ACCESS, text)}
    spans |= {("hex", m.start(), m.end()) for m in re.finditer(secrets.HEX, text)}
    got = {r.doc_id: r for r in secrets.report(docs).collect()}[1]
    found = {(k, int(a), int(b)) for k, a, b in (s.split(":") for s in got.spans.split(","))}
    assert {s for s in found if s[0] != "owned"} == spans and len(spans) > 1000
    out, at = [], 0
    for _, start, end in sorted(found, key=lambda s: (s[1], secrets.KINDS.index(s[0]))):
        if start >= at:
            out.append(text[at:start] + "<secret>")
        at = max(at, end)
    clean = {r.doc_id: r for r in secrets.redact(docs).collect()}
    assert clean[1].text == "".join(out) + text[at:] and clean[1].n_chars == len(clean[1].text)
    assert clean[2].text == "no secret"


def test_many_repositories_make_a_copied_example(spark):
    """Values of one owner: live in as many repositories as the bound, copied in one more."""
    few, many_held = "token=fewrepositories1", f"see {KEY} here"
    rows = [(i, few, "en", "a", 1) + ("x",) * data.EXTRA for i in range(secrets.MOST_REPOSITORIES)]
    rows += [(100 + i, many_held, "en", "a", 1) + ("x",) * data.EXTRA for i in range(secrets.MOST_REPOSITORIES + 1)]
    rows += [(200 + i, "secret=threeowners", "en", f"o{i}", 1) + ("x",) * data.EXTRA for i in range(3)]
    rows += [(300, "secret=nullowner1", "en", None, 1) + ("x",) * data.EXTRA]
    docs = data.frame(spark, rows)
    got = {r.doc_id: r for r in secrets.report(docs).collect()}
    assert (got[0].n_live, got[0].n_copied, got[0].owners, got[0].repositories) == (1, 0, "1", "20")
    assert (got[100].n_live, got[100].spans) == (0, "")  # a bare word that is no owner's secret is no span
    assert (got[200].n_live, got[200].n_copied, got[200].owners, got[200].repositories) == (0, 1, "3", "3")
    assert (got[300].n_live, got[300].owners, got[300].repositories) == (1, "1", "1")
    clean = {r.doc_id: r.text for r in secrets.redact(docs).collect()}
    assert clean[0] == "<secret>" and clean[100] == many_held and clean[200] == "secret=threeowners"
