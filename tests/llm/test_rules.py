import random
import re

from cairn.llm.rules import judge

WORD, SPACE = re.compile(r"[^\x20\x09-\x0D]+"), re.compile(r"[\x20\x09-\x0D]+")


def plain(text):
    words = WORD.findall(text or "")
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {i + j for places in at.values() if len(places) > 1 for i in places for j in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def normal(line):
    return re.sub("[0-9]", "0", SPACE.sub(" ", line).strip(" ").lower())


def plain_verdict(rows, limit=5, share=0.02):
    """doc -> (words removed, kept), from texts and hosts."""
    of_host = {}
    for text, host in rows:
        of_host.setdefault(host, set()).add(text or "")
    out = []
    for text, host in rows:
        lines = [x for x in (text or "").split("\n") if WORD.search(x)]
        bar = max(limit, min(share * len(of_host[host]), 100))
        number = lambda x: sum(any(normal(y) == normal(x) for y in t.split("\n")) for t in of_host[host])  # noqa: E731, B023
        gone = sum(len(WORD.findall(x)) for x in lines if number(x) > bar)
        n, _, _, _, repeat = plain(text)
        failed = n < 20 or 100 * repeat > 30 * n
        out.append((gone, failed, not failed and n - gone >= 20 and n - gone >= 0.5 * n))
    return out


def test_against_plain_code(documents):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(200)] + ["é|ü", "#x", "<b>", "50%"]
    line = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    common = ["Shared line  number 17 of the site", "another COMMON line"]
    texts = []
    for k in range(90):
        parts = [line(rng.randint(1, 12)) for _ in range(rng.randint(0, 9))]
        if k % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), common[k % 2] if k % 4 else "shared line number 99 OF the site")
        if k % 10 == 1:
            parts += parts[:2]
        if k % 15 == 2:
            parts = [common[0], common[1], line(3)] * 8
        texts.append("\n".join(parts))
    texts += [None, "", "  \n \t", texts[3], texts[3], " ".join(["a b c d e f g h"] * 12), " ".join("abcdefghi"), "one two\x85three four"]
    hosts = [["h1", "h2", None][k % 3] for k in range(len(texts))]
    got = {r.doc_id: r for r in judge(documents(texts, source=hosts), with_text=True).collect()}
    verdicts = plain_verdict(list(zip(texts, hosts)))
    for k, text in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain(text), text
        assert (r.words_removed, r.base_failed, r.kept) == verdicts[k], text
        assert len(WORD.findall(r.text)) == r.n_words - r.words_removed


def test_a_large_host_does_not_excuse_repeated_lines(documents):
    """The same lines in 120 documents go, whether their host has 120 documents or 7,120."""
    lines = "\n".join(f"this site uses cookies of the kind {chr(97 + k)} and others" for k in range(6))
    repeated = [f"{lines}\nsome words of its own, number {'x' * (k + 1)}" for k in range(120)]
    letters = lambda n: "".join(chr(97 + int(c)) for c in str(n))  # noqa: E731  digits are one to the normaliser
    other = [f"a text of its own {letters(k)} " + " ".join(letters(k * 7 + j) for j in range(30)) for k in range(7_000)]
    texts, hosts = repeated + repeated + other, ["small"] * 120 + ["large"] * 7_120
    got = {r.doc_id: r for r in judge(documents(texts, source=hosts)).collect()}
    assert all(got[k].words_removed == 60 and not got[k].kept for k in range(240))
    assert all(got[k].words_removed == 0 and got[k].kept for k in range(240, len(texts)))


def test_copies_are_one_document(documents):
    text = "\n".join(f"line {chr(97 + k)} with some words in it" for k in range(6))
    assert all(r.kept and r.words_removed == 0 for r in judge(documents([text] * 40)).collect())


def test_plan_has_no_python(spark, documents):
    df = judge(documents(["a b c\nd e f"] * 3))
    assert "Python" not in df._jdf.queryExecution().toString() and "Pandas" not in df._jdf.queryExecution().toString()


def test_awkward_rows(awkward, nothing):
    assert judge(awkward, host_col="source").count() == awkward.count()
    assert all(r.base_failed and not r.kept for r in judge(awkward).where("n_words = 0").collect())
    assert judge(nothing).count() == 0
