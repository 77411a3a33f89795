import hashlib
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from odd_rows import ODD
from panelkit.llm import fim


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


def plain_way(doc_id, text):
    """The contract, by slices of the string."""
    t, h = text or "", sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(t)
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h3 % 100 >= 90:
        return (doc_id, n, "plain", None, None, sha(t), sha(t))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if h4 % 100 < 20:
        form, out = "spm", f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"
    else:
        form, out = "psm", f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}"
    return (doc_id, n, form, a, b - a, sha(out), sha(t))


def test_equals_brute_force(make_docs):
    rng = random.Random(5)
    letters = "ab \n<>PSMé日😀"
    rows = [(i, "".join(rng.choice(letters) for _ in range(rng.randrange(60)))) for i in range(600)]
    rows += ODD + [(20000 + i, s) for i, s in enumerate(["<P>", "a<S>b", "<M", "<", "<P<S", "😀" * 70_000, "x" * 65_536 + "é" * 9])]
    got = fim.digests(make_docs(rows))
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(plain_way(*r) for r in rows)
    assert {r["form"] for r in got.collect()} == {"plain", "psm", "spm"}


def test_empty_table(make_docs):
    assert fim.digests(make_docs([])).count() == 0


def test_output_is_text_and_other_shares(make_docs):
    docs = make_docs([(i, f"text number {i}") for i in range(300)])
    never = fim.rearrange(docs, plain_from=100, spm_below=0)
    assert {r["form"] for r in never.collect()} == {"psm"}
    got = fim.rearrange(docs).select("doc_id", "output", fim.restored().alias("back")).collect()
    assert all(r["back"] == f"text number {r['doc_id']}" for r in got)
    assert sum(r["output"].startswith("<P>") for r in got) > 150


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("a<>PSM é😀\x00"), max_size=40).filter(lambda t: not any(s in t for s in ("<P>", "<S>", "<M>"))),
       st.integers(0, 40), st.integers(0, 40), st.sampled_from(["psm", "spm"]))
def test_rotations_are_undone(text, i, j, form):
    a, b = sorted((min(i, len(text)), min(j, len(text))))
    buf = bytearray(text.encode())
    fim.arrange(buf, *fim.offsets(buf, (a, b)), form)
    want = f"<P>{text[:a]}<S>{text[b:]}<M>{text[a:b]}" if form == "psm" else f"<S>{text[b:]}<P>{text[:a]}<M>{text[a:b]}"
    assert buf.decode() == want and fim.restore(want, form) == text
