"""Fill-in-middle against a plain version, block by block and over odd tables."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from crossfeed.llm import infill


def numbers_of(doc_id):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * n:8 * n + 8], 16) for n in range(4)]


def plain_version(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = numbers_of(doc_id)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(mark in text for mark in infill.MARKS):
        return len(units), "plain", None, None, text
    if h[3] % 100 < 50:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("block", [3, 1 << 20])
def test_scatter_and_gather(monkeypatch, block):
    monkeypatch.setattr(infill, "BLOCK", block)
    rng = random.Random(block)
    fixed = [None, "", "\n", "\n\n", "a", "ß\n", "<P>", "<", "P>", "<P", "<S", "<M>\n", ">"]
    for _ in range(150):
        texts = [rng.choice(fixed + ["".join(rng.choice("aß\n<€𝄞>PSM") for _ in range(rng.randint(0, 40)))] * 9)
                 for _ in range(rng.randint(1, 12))]
        ids = [rng.choice([None, *range(50)]) for _ in texts]
        data, offsets = infill._bytes(pa.array(texts, pa.string()))
        cuts = infill.cut(data, offsets, np.array([numbers_of(i) for i in ids]), 100, 50)
        out, out_offsets = infill.rearranged(data, offsets, cuts)
        outputs = infill._texts(out, out_offsets).to_pylist()
        back = infill._texts(*infill.put_back(out, out_offsets, cuts["form"])).to_pylist()
        start, a, b = infill._points_before(data, [offsets[:-1], cuts["a"], cuts["b"]])
        for row, (doc_id, text) in enumerate(zip(ids, texts)):
            lines, form, prefix, middle, output = plain_version(doc_id, text)
            assert (cuts["lines"][row], ("plain", "psm", "spm")[cuts["form"][row]]) == (lines, form)
            assert (outputs[row], back[row]) == (output, text or "")
            assert form == "plain" or (a[row] - start[row], b[row] - a[row]) == (prefix, middle)


def test_odd_documents(spark, odd_docs, no_docs):
    more = odd_docs.withColumn("text", F.concat("text", F.lit("\nline 2\n<S> in it\nend")))
    docs = odd_docs.withColumn("text", F.concat("text", F.lit("\nsecond line\nthird"))).unionByName(odd_docs).unionByName(more)
    moved = infill.transform(docs)
    moved = moved.withColumn("restored", infill.restored(F.col("output"), F.col("form"))).collect()
    key = repr
    expected = sorted(((row["doc_id"], *plain_version(row["doc_id"], row["text"]), row["text"] or "") for row in docs.collect()), key=key)
    assert sorted((tuple(row) for row in moved), key=key) == expected
    assert infill.transform(no_docs).collect() == []


def test_rates(odd_docs):
    none = infill.transform(odd_docs, rate=0)
    assert none.filter("form <> 'plain'").isEmpty()
    forms = {row["form"] for row in infill.transform(odd_docs, spm_rate=100).select("form").distinct().collect()}
    assert forms == {"plain", "spm"}
