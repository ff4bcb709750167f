"""Operator 3 against brute force over every byte position."""

import hashlib
import random

import pytest

from auditlens.llm.suffix_dedup import anchor_runs, cut, merge, remove_repeats


def brute(rows, threshold):
    seen = {}
    datas = [(i, (t or "").encode()) for i, t in rows]
    for _, b in datas:
        for p in range(len(b) - threshold + 1):
            s = b[p : p + threshold]
            seen[s] = seen.get(s, 0) + 1
    out = []
    for i, b in datas:
        spans = merge([(p, p + threshold) for p in range(len(b) - threshold + 1) if seen[b[p : p + threshold]] > 1])
        kept, at = b"", 0
        for x, y in spans:
            kept, at = kept + b[at:x], y
        kept += b[at:]
        out.append((i, len(b), len(b) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r[0], r._n_bytes, r._n_removed, r._n_spans, r._sha256) for r in df.collect()), key=repr)


def corpus(words, threshold):
    rng = random.Random(11)
    text = lambda n: " ".join(rng.choices(words, k=n))
    passages = [text(n)[:m] for n, m in ((80, threshold - 1), (80, threshold), (80, threshold + 1), (200, 3 * threshold), (300, 5 * threshold + 7))]
    rows = [(i, text(rng.choice([1, 10, 60, 200]))) for i in range(20)]
    for i in range(40):
        p = rng.choice(passages)
        cuts = sorted(rng.sample(range(len(p) + 1), 2)) if i % 3 == 0 else (0, len(p))
        rows.append((100 + i, text(rng.randint(0, 40)) + rng.choice(["", " ", "é"]) + p[cuts[0] : cuts[1]] + text(rng.randint(0, 40))))
    whole = text(150)
    rows += [(200, whole), (201, whole), (202, whole + "x"), (203, "y" + whole), (204, whole[50:]), (205, "short"), (206, "short"), (207, None), (208, "")]
    rows += [(300, "ab" * 400), (301, "z" * 900), (302, "z" * 500), (303, passages[3] + passages[3]), (304, passages[4][:-3] + "é" + passages[4])]
    return rows


@pytest.mark.parametrize("threshold", [64, 100, 400])
def test_equals_brute_force(spark, table, words, threshold):
    rows = corpus(words, threshold)
    assert result(cut(table(rows, extra=["a", "s", "hull"]), ["doc_id"], threshold)) == brute(rows, threshold)


def test_repeated_and_null_ids(spark, table, words):
    rows = corpus(words, 64)[:40]
    rows += [rows[0], rows[0], (rows[1][0], "other " + rows[25][1]), (None, rows[30][1]), (None, None)]
    assert result(cut(table(rows), ["doc_id"], 64)) == brute(rows, 64)


def test_texts_of_the_stage(spark, table, words):
    base = " ".join(words[:200])
    docs = table([(1, base), (2, "né " + base + " end"), (3, None), (4, "lone")], extra=["_spans"])
    got = {r.doc_id: r for r in remove_repeats(docs).collect()}
    assert remove_repeats(docs).columns == docs.columns
    assert got[1].text == "" and got[1].n_chars == 0
    assert got[2].text == "né  end" and got[2].n_chars == 7
    assert got[3].text is None and got[4].text == "lone" and got[4].n_chars == 4


def test_texts_travel_once_and_in_slices(spark, table, words, monkeypatch):
    """A second copy of the texts, or a whole batch handed back at once, takes the executors' memory."""
    from auditlens.llm.common import SLICE_ROWS

    base = " ".join(words[:60])
    docs = table([(i, None if i % 7 == 0 else f"{i} {base} {i}") for i in range(SLICE_ROWS + 90)])
    frame, sizes = type(docs), []
    real = frame.mapInArrow

    def seen(self, run, schema, *rest):
        sizes.append(self.columns)

        def sized(batches):
            for out in run(batches):
                assert out.num_rows <= 40 * SLICE_ROWS
                if "_sha256" in out.schema.names:
                    assert out.num_rows <= SLICE_ROWS
                yield out

        return real(self, sized, schema, *rest)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    got = {r.doc_id: r.text for r in remove_repeats(docs, 64).collect()}
    assert len(sizes[-1]) == 1 + len(docs.columns)  # the spans and each column
    assert len(got) == SLICE_ROWS + 90 and got[7] is None and all(len(t) < len(base) for t in got.values() if t)


def test_empty(spark, table):
    assert cut(table([]), ["doc_id"]).collect() == []


def test_runs_cover_every_start_once(words):
    data = (" ".join(words[:900]) + "q" * 700).encode()
    a, s, e = anchor_runs(data, 400)
    covered = [p for x, y in zip(s, e, strict=True) for p in range(x, y + 1)]
    assert covered == list(range(len(data) - 399))
    assert all(x <= z <= y + 200 and z >= y for z, x, y in zip(a, s, e, strict=True) if z >= y) and (a >= e).all()
