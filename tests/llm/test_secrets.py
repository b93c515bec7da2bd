import hashlib
import re
import time

from tests.llm.helpers import ODD_TEXTS, documents
from tidemart.llm import secrets as S

KEY, OTHER_KEY = "AKIA" + "Z7" * 8, "AKIA" + "Q" * 13
BARE = "wJalrXUtnFEMI/K7MDENG+bPxRfiCYEXAMPLE0"
TEXTS = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [
    (20, f"é {KEY} and {BARE} at https://db.example.org:5432/x"),  # all three parts together
    (21, f"{BARE} alone, and https://db.example.org/x alone"),  # weak parts without a partner
    (22, f"{KEY}\n \n{BARE}"),  # another scope
    (23, f"{KEY} {'far ' * 60}{BARE}"),  # out of reach
    (24, "client_id = backoffice-7, PassWord: 'abcdefghijkl', token=password : abcdefghijklmnop"),
    (25, f"{OTHER_KEY} too short; token=short; 0123456789abcdef and 0123456789abcde"),
    (26, "api_key=\"a=b=c=d=e=f=g\" APIKEY==0123456789ab secret:x"),
    (27, f"{KEY} {KEY}"), (27, f"{KEY} {KEY}"), (None, f"username: someone {BARE}"),
]


def plain_spans(text, reach=S.REACH):
    text, parts = text or "", []
    for kind, pattern in ((k, getattr(S, k.upper())) for k in S.KINDS):
        for m in re.finditer(pattern, text):
            if kind == "assign" and len(m[2]) < 12:
                continue
            if kind == "bare" and not all(re.search(c, m[0]) for c in ("[0-9]", "[A-Z]", "[a-z]")):
                continue
            parts.append((m.start(), S.KINDS.index(kind), m.end()))
    ends = [m.end() for m in re.finditer(S.SCOPE, text)]
    scopes = {p: sum(e <= p[0] for e in ends) for p in parts}
    base = sorted(p for p in parts if p[1] < S.FIRST_WEAK)
    weak = [
        p for p in parts if p[1] >= S.FIRST_WEAK and any(
            S.KINDS[o[1]] in S.NEEDS[S.KINDS[p[1]]] and abs(o[0] - p[0]) <= reach and scopes[o] == scopes[p]
            and (o[2] <= p[0] or p[2] <= o[0]) for o in parts)
    ]
    return base, sorted(base + weak)


def test_odd_rows(spark, rows):
    found = S.find_secrets(documents(spark, TEXTS, extra="spans"))
    expected = []
    for doc, text in TEXTS:
        base, spans = plain_spans(text)
        expected.append((doc, base, spans))
    got = [(r.doc_id, [tuple(s) for s in r.base], [tuple(s) for s in r.spans]) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    linked = {d for d, base, spans in expected if len(spans) > len(base)}
    assert linked == {20, 24, None}


def test_contract_lengths(spark):
    """Patterns with lengths in them give what the open patterns and a test afterwards give."""
    open_patterns = {"access": ("AKIA[A-Z0-9]+", 18), "hex": ("[0-9a-f]+", 16)}
    for kind, (pattern, least) in open_patterns.items():
        for _, text in TEXTS:
            plain = [m.span() for m in re.finditer(pattern, text or "") if len(m[0]) >= least]
            assert plain == [m.span() for m in re.finditer(getattr(S, kind.upper()), text or "")]


def test_listing_and_digest(spark):
    row = S.find_secrets(documents(spark, [(1, f"x {KEY}")])).select(S.listed("base").alias("base")).first()
    assert row.base == "access:2:22" and len(hashlib.sha256(row.base.encode()).hexdigest()) == 64


def test_redacted_texts(spark):
    docs = documents(spark, TEXTS, extra="base")
    out = S.redacted(docs, mark="<x>")
    assert out.columns == docs.columns and out.count() == len(TEXTS)
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[20] == "é <x> and <x> at <x>" and texts[22] == f"<x>\n \n{BARE}" and texts[0] is None and texts[3] == "one"


def test_main_path_has_no_python(spark):
    docs = documents(spark, TEXTS).repartition(2)
    for frame in (S.with_parts(docs), S.find_secrets(docs), S.redacted(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|NestedLoop|Cartesian", plan)


def test_very_long_texts_with_many_hits(spark):
    """More hits and scopes than a block holds; 100,000 hits in one text take seconds."""
    small = "".join(f"{KEY} é {i:016x} {BARE}\n\nclient_id=backoffice-{i} {BARE}\n \n" for i in range(700))
    docs = documents(spark, [(1, small), (2, "0123456789abcdef " * 100_000)])
    began = time.monotonic()
    out = {r.doc_id: r for r in S.find_secrets(docs).collect()}
    texts = {r.doc_id: r.text for r in S.redacted(docs, mark="<x>").collect()}
    assert time.monotonic() - began < 120
    assert ([tuple(s) for s in out[1].base], [tuple(s) for s in out[1].spans]) == plain_spans(small)
    at, pieces = 0, []
    for start, _, end in plain_spans(small)[1]:
        if start >= at:
            pieces += [small[at:start], "<x>"]
        at = max(at, end)
    assert texts[1] == "".join(pieces) + small[at:] and len(pieces) > 4 * S.BLOCK
    assert len(out[2].base) == 100_000 and out[2].base[-1][2] == 1_699_999 and texts[2] == "<x> " * 100_000


def test_empty_table(spark):
    assert S.find_secrets(documents(spark, [])).count() == 0
