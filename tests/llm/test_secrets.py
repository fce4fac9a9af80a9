import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from weftline.llm.automaton import compile_rules
from weftline.llm.secret_scan import BASE, RULES, automaton_of, find_secrets, scan_text

from .conftest import prose

AUTOMATON = automaton_of(RULES)

#: (kind, regex, group that is measured, least length): the rules as a regex library runs them.
PLAIN = [
    ("assign", r"((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("github", r"gh[opsur]_[A-Za-z0-9]+", 0, 24),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
]


def by_regex(text, rules=PLAIN):
    out = [(m.start(), k, m.end()) for k, (_, p, g, least) in enumerate(rules) for m in re.finditer(p, text) if len(m[g]) >= least]
    return [{"kind": rules[k][0], "start": s, "end": e} for s, k, e in sorted(out)]


@settings(max_examples=500)
@given(st.text(alphabet="abAB01x", max_size=30))
def test_automaton_equals_regexes(text):
    rules = ["a[bx]{2,3}0+", "(AB|ab)+1x*", "0{3}1", "B[a-z]*A", "[01]{4}[01]*"]
    want = sorted((m.start(), k, m.end()) for k, r in enumerate(rules) for m in re.finditer(r, text))
    assert [(s, k, e) for s, k, e, _ in compile_rules(rules).spans(text.encode())] == want


def test_rules_that_a_pass_cannot_tell_are_refused():
    for bad in ("a*", "ab(cd)*", "a"):
        with pytest.raises(ValueError):
            compile_rules([bad])


PIECES = ["password", "PassWd", "api_key", "APIKEY", "secret", "ToKen", ' "', "'", "=", ":", " ", "\t", "\n", "abcdef", "0123456789abcdef01234567", "AKIA", "AK", "ABCDEFGH0123456789", "é", "\U0001f600", "==", "a.b-c_d/e+f", "ghp_", "xoxb-", "eyJ", ".eyJ", ".", "abcdefghijklmnopqrst", "-----BEGIN RSA PRIVATE KEY-----", "-----BEGIN ", "ſecret=abcdefgh", "toKen=abcdefgh", "secretoken=abcdefgh"]


@settings(max_examples=1500)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join))
def test_scan_finds_what_the_regexes_find(text):
    assert scan_text(text, AUTOMATON, RULES) == by_regex(text)


def test_long_texts_equal_regexes():
    rng = random.Random(5)
    for _ in range(40):
        text = " ".join(rng.choice(PIECES) if rng.random() < 0.3 else prose(rng, 3) for _ in range(800))
        assert scan_text(text, AUTOMATON, RULES) == by_regex(text)


def test_base_rules_as_stated():
    base = automaton_of(BASE)
    at = lambda t: [(x["kind"], t[x["start"] : x["end"]]) for x in scan_text(t, base, BASE)]
    assert at("x password = 'hunter22' y") == [("assign", "password = 'hunter22")]
    assert at("token=abc") == [] and at("Token: abcdef") == [("assign", "Token: abcdef")]
    assert at("password: token: abcdefgh") == []  # the failing match has consumed the second keyword
    assert at("AKIA" + "A" * 16) == [("access", "AKIA" + "A" * 16)] and at("AKIA" + "A" * 15) == []
    assert at("z" + "0a" * 12) == [("hex", "0a" * 12)] and at("0a" * 11) == []
    assert at("\U0001f600 secret=abcdef0") == [("assign", "secret=abcdef0")]
    assert scan_text("\U0001f600 secret=abcdef0", base, BASE)[0]["start"] == 2


def test_query_rows(odd_docs, no_docs, bare):
    got = find_secrets(odd_docs).collect()
    assert len(got) == odd_docs.count() and all(r.spans == [] for r in got)
    assert find_secrets(no_docs).count() == 0
    text = "p " * 50_000 + "password=abcdef1"
    assert [[tuple(s) for s in r.spans] for r in find_secrets(bare([(1, text)])).collect()] == [[("assign", 100_000, 100_016)]]
