import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from pricegrid.llm import pii

# The stated patterns, as plainly as possible.
PLAIN = [
    re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    re.compile(r"[0-9]([\x20-]?[0-9])+"),
    re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def luhn(digits):
    total = sum(int(c) for c in digits[-1::-2]) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def plain(text):
    out = []
    for kind, p in enumerate(PLAIN):
        for m in p.finditer(text):
            d = re.sub("[^0-9]", "", m[0])
            ok = (
                kind == 0
                or kind == 1 and all(int(x) <= 255 for x in m[0].split("."))
                or kind == 2 and 14 <= len(d) <= 19 and luhn(d)
                or kind == 3 and 10 <= len(d) <= 15
            )
            if ok:
                out.append((kind, m.start(), m.end()))
    return sorted(out)


@settings(max_examples=600)
@given(st.text(alphabet="a1 .@-+(5%_é\n", max_size=60))
def test_base_is_the_stated_patterns(text):
    assert sorted(pii.detect(text)) == plain(text)


@given(st.text(alphabet="0123456789 -+.", max_size=80))
def test_base_on_digits(text):
    assert sorted(pii.detect(text)) == plain(text)


def added(text):
    return [(pii.KINDS[k], text[s:e]) for k, s, e in pii.find(text)[1]]


def test_disguises_map_back_to_source_characters():
    assert added("é write to john (at) example (dot) com now") == [("email", "john (at) example (dot) com")]
    assert added("jane at mail dot example dot org, he said") == [("email", "jane at mail dot example dot org")]
    assert added("bob [at] a.org") == [("email", "bob [at] a.org")]
    assert added("jоe@example.com") == [("email", "jоe@example.com")]  # Cyrillic o
    phone = "plus four four one two three four five six seven eight nine zero"
    assert added(f"call {phone} today") == [("phone", phone)]
    card = "４０４１８９４９７４６０８７９５"
    assert added(f"x {card} y") == [("card", card)]
    assert added("10.1​.2.3") == [("ip", "10.1​.2.3")]


def test_plain_prose_has_no_spans():
    assert pii.find("Look at the door. One, two, three. A dot on a map at noon; meet at example.com.") == ([], [])


def test_base_spans_stay_when_a_disguise_surrounds_them():
    text = "j​oe@ex.org"
    base, more = pii.find(text)
    assert base and (0, 0, len(text)) in more


def test_long_runs_take_linear_time():
    for unit in ("a", "1", "1.", "a@", "+1", "1 ", "a.", " dot ", "a at ", "one "):
        pii.find(unit * (300_000 // len(unit)))


def test_table(spark, documents, by_id):
    rows = [(1, "a@b.co 42.144.35.254"), (2, None), (3, ""), (None, "+1 (988) 555-2485"), (1, "nothing"), (5, "x" * 200_000 + " q@w.er")]
    got = by_id(pii.find_personal_data(documents(rows)))
    first = [r for r in got[1] if r.n_email][0]
    assert first.spans == "email:0:6,ip:7:20" and len(got[1]) == 2
    assert first.base_sha256 == hashlib.sha256(first.spans.encode()).hexdigest()
    for k in (2, 3):
        assert got[k][0].spans == "" and got[k][0].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[None][0].n_phone == 1 and got[5][0].spans == "email:200001:200007"
    assert pii.find_personal_data(documents([])).count() == 0


# The disguises as one pattern without limits on lengths and labels; slow on long texts.
LABEL = r"[A-Za-z0-9][A-Za-z0-9_%+-]*"
DOT = r"(?:\s?[\[({<]\s?(?:(?i:dot)|\.)\s?[\])}>]\s?| (?i:dot) )"
AT = r"(?:\s?[\[({<]\s?(?:(?i:at)|@)\s?[\])}>]\s?|@)"
WHOLE = re.compile(
    rf"(?<![A-Za-z0-9_%+-])(?P<name>{LABEL}(?:(?:\.|{DOT}){LABEL})*)"
    rf"(?:(?P<mark>{AT})(?P<host>{LABEL}(?:(?:\.|{DOT}){LABEL})+)|(?P<bare> (?i:at) )(?P<host2>{LABEL}(?:{DOT}{LABEL})+))"
)


def brute_disguises(text):
    edits = []
    for m in WHOLE.finditer(text):
        kind, host = ("mark", "host") if m["mark"] is not None else ("bare", "host2")
        for part in ("name", host):
            edits += [(d.start(), d.end(), ".") for d in re.finditer(DOT, text[: m.end(part)]) if d.start() >= m.start(part)]
        if m[kind] != "@":
            edits.append((*m.span(kind), "@"))
    return sorted(edits)


PIECES = ["a", "b1", "-", "_x", ".", " ", "at", " at ", "@", "(at)", " [ @ ] ", " dot ", "(dot)", " <.> ", "dot", "Dot", "\n", "é"]


@settings(max_examples=3000, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_disguises_equal_the_pattern_without_limits(text):
    want = brute_disguises(text) if pii._AT_HINT.search(text) else []
    assert pii.at_and_dot(text) == want


def test_long_names_and_many_labels():
    name = "n" * 70
    assert added(f"to {name} (at) host (dot) org.") == [("email", f"{name} (at) host (dot) org")]
    host = " (dot) ".join(f"label{k}" for k in range(12))
    assert added(f"x@{host} end") == [("email", f"x@{host}")]
    long = "n" * 100_000 + " (at) " + "h" * 100_000 + " dot org"
    assert added(long) == [("email", long)]
    many = " dot ".join(["l"] * 20_000)
    assert added(f"{many} at {many}") == [("email", f"{many} at {many}")]


def test_disguises_take_linear_time():
    for unit in ("a (at) ", "a(dot)", "(at)a.b ", "_(at)a(dot)b", "a dot a at ", "- (at) a dot a", "a@"):
        pii.find(unit * (200_000 // len(unit)) + " (dot) ")
