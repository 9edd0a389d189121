import random
import re
import textwrap

import pytest

from ledgerloom.llm import licenses
from ledgerloom.llm.queries import QUERIES

ALL = licenses.TEMPLATES | licenses.NOTICES
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_force(text):
    words = WORD.findall(lower(text))
    base = [
        {"label": label, "word": i}
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    found = []
    for template, label in ALL.items():
        every = WORD.findall(lower(template))
        wanted, span = set(every), -(-len(every) * 5 // 4)
        for s in (i for i, w in enumerate(words) if w in wanted):
            block = words[s : s + span]
            shared = len(wanted & set(block))
            if shared >= 0.8 * len(wanted) - 1e-9:
                found.append(
                    {"label": label, "first_word": s, "n_words": len(block), "containment": shared / len(wanted)}
                )
    return len(words), sort(base), sort(found)


def sort(rows):
    return sorted((dict(sorted(r.items())) for r in rows), key=str)


def texts():
    rng = random.Random(5)
    pool = WORD.findall(lower(" ".join(licenses.TEMPLATES))) + ["alpha", "été", "42"]
    out = [None, "", "MIT License", "the mit-license and GNU General Public License; mit\nlicense", "Apache\tLicense mit license mit license"]
    out += list(licenses.TEMPLATES) + [t.upper() + "!" for t in licenses.TEMPLATES]
    out += [" ".join(rng.choice(pool) for _ in range(rng.randint(1, 200))) for _ in range(150)]
    out += ["\n".join(rng.sample(out[5:], 3)) for _ in range(30)]
    out.append("word " * 40_000 + "Released under the MIT License")
    return out


def test_join_finds_every_block(llm, make):
    every = texts()
    rows = list(enumerate(every)) + [(3, every[3]), (None, every[4])]
    frame = make(rows)
    templates = licenses.prepare_templates(frame, licenses.template_table(llm))
    marked = licenses.with_licenses(frame, templates)
    assert set(frame.columns) < set(marked.columns)
    n = 0
    for r in marked.collect():
        got = r["licenses"].asDict(recursive=True)
        expected = brute_force(r["text"])
        assert (got["n_words"], sort(got["base"]), sort(got["found"])) == expected
        n += len(expected[2])
    assert n > 60 and marked.count() == len(rows)


def test_any_block_shares_no_more_than_those_looked_at():
    # Blocks may begin anywhere: none has more than the best that begins at a template word.
    for text in texts()[:120]:
        words = WORD.findall(lower(text))[:400]
        best = {}
        for m in brute_force(" ".join(words))[2]:
            best[m["label"]] = max(best.get(m["label"], 0), m["containment"])
        anywhere = {}
        for template, label in ALL.items():
            every = WORD.findall(lower(template))
            wanted, span = set(every), -(-len(every) * 5 // 4)
            for s in range(len(words)):
                share = len(wanted & set(words[s : s + span])) / len(wanted)
                if share >= 0.8 - 1e-9:
                    anywhere[label] = max(anywhere.get(label, 0), share)
        assert anywhere == best


def test_global_order_is_by_corpus_frequency(llm, make):
    frame = make([(1, "mit mit mit license Released the"), (2, None)])
    order = licenses.prepare_templates(frame, licenses.template_table(llm)).words
    assert order[-1] == b"mit" and order.index(b"bsd" if b"bsd" in order else b"gnu") < order.index(b"license")


def test_empty_tables(llm, make):
    frame = make([])
    assert licenses.with_licenses(frame, licenses.prepare_templates(frame, licenses.template_table(llm))).count() == 0
    none = llm.createDataFrame([("x", None), ("y", " ..."), (None, "")], "label string, text string")
    some = make([(1, "released under the mit license"), (2, None)])
    found = licenses.with_licenses(some, licenses.prepare_templates(some, none), "n").collect()
    assert sorted((r["n"]["n_words"], len(r["n"]["base"]), len(r["n"]["found"])) for r in found) == [(0, 0, 0), (5, 1, 0)]


def test_templates_are_a_table_of_bounded_size(llm, make, monkeypatch):
    table = llm.createDataFrame([("own", "we grant nothing to anybody")] * 3, "label string, text string")
    frame = make([(1, "Hereby WE grant\nnothing, to anybody at all"), (2, "we grant something")])
    found = licenses.with_licenses(frame, licenses.prepare_templates(frame, table))
    kept = {r["doc_id"]: [m["containment"] for m in r["licenses"]["found"]] for r in found.collect()}
    assert kept == {1: [1.0, 0.8], 2: []}
    monkeypatch.setattr(licenses, "MAX_TEMPLATE_CHARS", 10)
    with pytest.raises(ValueError, match="templates"):
        licenses.prepare_templates(frame, table)


def labels_of(llm, tmp_path, every):
    frame = llm.createDataFrame(list(enumerate(every)), "doc_id long, text string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    rows = QUERIES["op6_licenses"](llm, str(tmp_path)).collect()
    return {r["doc_id"]: (r["labels"].split(","), r["score"]) for r in rows}


def test_notices_wrapped_at_every_word(llm, tmp_path):
    wanted, every = [], []
    for template, label in licenses.TEMPLATES.items():
        w = template.split(" ")
        wraps = [" ".join(w[:k]) + end + " ".join(w[k:]) for k in range(1, len(w)) for end in ("\n", "\r\n * ")]
        for k, wrapped in enumerate([*wraps, "\n".join(w)]):
            wanted.append(label)
            every.append("word " * (7 * k) + "\n" + wrapped + "\nmore text")
    got = labels_of(llm, tmp_path, every)
    assert all(label in got[i][0] and got[i][1] == 1.0 for i, label in enumerate(wanted))


def test_scattered_words_of_several_lines_are_no_notice(llm, tmp_path):
    apart = "Released in May.\nThe end.\nLicensed under the Apache License, Version 2.0"
    assert labels_of(llm, tmp_path, [apart])[0][0] == ["apache", "apache-2.0"]


def test_paragraphs_of_real_notices(llm, tmp_path):
    every = [textwrap.fill(t, 60, initial_indent="# ", subsequent_indent="# ") for t in licenses.NOTICES]
    got = labels_of(llm, tmp_path, every + ["# alpha\n" * 90])
    assert all(label in got[i][0] and got[i][1] == 1.0 for i, label in enumerate(licenses.NOTICES.values()))
    assert got[len(every)] == ([""], 0.0)


def test_long_templates(llm, make):
    long = [f"w{k}" for k in range(100)]
    texts_ = [" ".join(["x"] * n + long[:keep]) for n in (0, 17, 50) for keep in (100, 80, 79)]
    frame = make(list(enumerate(texts_)))
    marked = licenses.with_licenses(frame, licenses.prepare_templates(frame, licenses.template_table(llm, {" ".join(long): "long"})))
    got = {r["doc_id"]: {m["containment"] for m in r["licenses"]["found"]} for r in marked.collect()}
    assert [max(got[i], default=None) for i in range(9)] == [1.0, 0.8, None] * 3
