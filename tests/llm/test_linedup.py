from hashlib import md5

from rootweave.llm import linedup


def digest(text):
    return md5(text.encode()).hexdigest()


def plain(docs, window=2, mean=4):
    """(id, text) after removal, by the same chunks."""
    seen, out = {}, {}
    for i, text in sorted(set(docs), key=lambda d: (d[0], digest(d[1]))):
        lines, kept, chunk = text.split("\n"), [], []
        for k, line in enumerate(lines):
            chunk.append(line)
            near = "".join(digest(x) for x in lines[max(0, k - window + 1) : k + 1])
            if k == len(lines) - 1 or k >= window - 1 and digest(near)[:2] < f"{256 // mean:02x}":
                passage = "\n".join(chunk)
                if len(chunk) > 1 and passage.strip(" \n\t\r") and passage in seen:
                    pass
                else:
                    seen[passage] = i
                    kept += chunk
                chunk = []
        out[i, text] = "\n".join(kept)
    return out


def test_repeated_chunks_stay_once(spark, ws):
    passage = "\n".join(f"shared line number {k}" for k in range(30))
    docs = [(i, f"own {i}\nmore {i}\n{passage}\nend {i}") for i in range(40)] + [(50 + i, f"own {i}\n\n\n\n\nfree {i}") for i in range(20)]
    docs += [(90, passage), (91, passage)]
    found = linedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), ws, removed_col="gone").collect()
    expected = plain(docs)
    texts = dict(docs)
    assert {row["doc_id"]: row["text"] for row in found} == {i: t for (i, _), t in expected.items()}
    assert sum(row["gone"] for row in found) > 800
    assert all(row["text"] == texts[row["doc_id"]] for row in found if 50 <= row["doc_id"] < 90)


def test_boundaries_meet_again_after_an_insertion(spark, ws):
    lines = [f"line {k} of a long text" for k in range(200)]
    docs = [(1, "\n".join(lines)), (2, "\n".join(["new"] + lines[:90] + ["other"] + lines[90:]))]
    found = linedup.drop_repeated_lines(spark.createDataFrame(docs, "doc_id long, text string"), ws).collect()
    assert len(next(r["text"] for r in found if r["doc_id"] == 2).split("\n")) < 30


def test_odd_rows(spark, odd, empty, ws):
    found = linedup.drop_repeated_lines(odd, ws)
    assert found.columns == odd.columns
    rows = found.collect()
    assert len(rows) == odd.count()
    by_id = {row["doc_id"]: row["text"] for row in rows if row["doc_id"] is not None}
    assert by_id[0] is None and by_id[1] == "" and by_id[2] == " \n\t "
    # The repeated row is the same document; its copy under another id is not.
    assert [r["text"] for r in rows if r["doc_id"] == 7][0] == [r["text"] for r in rows if r["doc_id"] == 7][1] != ""
    assert len(by_id[8]) < len(by_id[7]) <= len("a\nb\nc\n" * 40)
    assert linedup.drop_repeated_lines(empty, ws).count() == 0
