"""Texts without the lines that many documents of a host have (op7), against plain Python."""

import re
from collections import Counter

from recoflow.llm import quality

FOOTER, RARE = "All rights  reserved by the Example Host", "a line that only few documents have"


def rows():
    own = lambda i: "\n".join(" ".join(f"word{i}n{k}x{j}" for j in range(9)) for k in range(3))
    out = [(i, f"{own(i)}\n{FOOTER if i % 2 else FOOTER.upper().replace('  ', ' ')}\n", "a") for i in range(12)]
    out += [(20 + i, f"{own(i)}\n\n{FOOTER}", "b") for i in range(3)]                     # too few of that host
    out += [(30 + i, f"{own(50 + i)}\n{RARE}", "a") for i in range(2)]
    out += [(40, FOOTER + "\n" + FOOTER + "\nshort rest of four words", "a"), (41, None, "a"), (42, "", None), (43, own(7), None)]
    return out + [out[0], out[-1]]


def want(docs, min_docs, max_share):
    tidy = lambda line: re.sub(r"[ \t-\r]+", " ", line.lower()).strip(" ")
    lines = [[(tidy(x), x) for x in (t or "").split("\n")] for _, t, _ in docs]
    hosts = Counter(s or "" for _, _, s in docs)
    having = Counter((s or "", x) for (_, _, s), ls in zip(docs, lines) for x in {k for k, _ in ls if k})
    often = {k for k, n in having.items() if n >= min_docs and 100 * n > max_share * hosts[k[0]]}
    out = []
    for (doc, text, host), ls in zip(docs, lines):
        n = len(re.findall(r"[^ \t-\r]+", text or ""))
        left = n - sum(len(k.split(" ")) for k, _ in ls if (host or "", k) in often)
        grams = Counter(tuple(w) for w in zip(*[re.findall(r"[^ \t-\r]+", text or "")[i:] for i in range(5)]))
        if n >= 10 and max(grams.values()) == 1 and left >= 10 and 100 * left >= 30 * n:
            out.append((doc, "\n".join(x for k, x in ls if (host or "", k) not in often), host, "kept"))
    return sorted(out, key=repr)


def test_clean_removes_lines_and_rejects_depleted_documents(spark):
    docs = rows()
    df = spark.createDataFrame([(*d, "kept") for d in docs], "doc_id long, text string, source string, _row string")
    got = sorted((tuple(r) for r in quality.clean(df).collect()), key=repr)
    assert got == want(docs, quality.MIN_DOCS, quality.MAX_SHARE)
    texts = {r[0]: r[1] for r in got}
    assert FOOTER not in texts[1] and texts[20].endswith(FOOTER) and texts[30].endswith(RARE) and not {40, 41, 42} & set(texts)
    assert quality.clean(df.limit(0)).count() == 0


def test_clean_agrees_with_judge(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string, source string")
    judged = sorted(r.doc_id for r in quality.judge(df).filter("kept").collect())
    assert judged == sorted(r.doc_id for r in quality.clean(df).collect())
