"""Records cut by many tasks against a plain reader that goes through each file once."""

import random

import pytest
from pyspark.sql import functions as F

from matchguard.operators.normalize import with_record_index
from matchguard.sources.readers import read_raw_csv

SPACE = " \t\x0b\x0c\r  "


def plain(text):
    """All records of a text, cell by cell, character by character."""
    text = text.replace("\r\n", "\n")
    records, i, n = [], 0, len(text)
    while i < n:
        if text[i] == "\n":
            i += 1
            continue
        record = []
        while True:
            while i < n and text[i] in SPACE:
                i += 1
            cell = ""
            if i < n and text[i] == '"':
                i += 1
                while i < n:
                    if text[i] != '"':
                        cell += text[i]
                        i += 1
                    elif text[i + 1 : i + 2] == '"':
                        cell += '"'
                        i += 2
                    elif text[i + 1 : i + 2] in (",", "\n", ""):
                        i += 1
                        break
                    else:
                        cell += '"'
                        i += 1
            else:
                while i < n and text[i] not in ",\n":
                    cell += text[i]
                    i += 1
            record.append(cell)
            if i < n and text[i] == ",":
                i += 1
                continue
            i += 1
            break
        records.append(record)
    return records


def expected(texts):
    """(file, index, {name: cell}) of every record that is not blank."""
    out = []
    for name, text in texts.items():
        head, *rest = plain(text) or [[]]
        at = {h.strip(): k for k, h in enumerate(head) if h.strip()}
        kept = [r for r in rest if len(r) > 1 or r[0].strip()]
        out += [(name, i + 1, {c: (r[k].strip() if k < len(r) else "") for c, k in at.items()}) for i, r in enumerate(kept)]
    return out


def read(spark, folder, texts, block):
    for name, text in texts.items():
        (folder / name).write_bytes(text.encode())
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        df = with_record_index(read_raw_csv(spark, str(folder)))
        rows = [r.asDict() for r in df.collect()]
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    names = [c for c in df.columns if c not in ("source_file", "source_path", "source_offset", "source_line", "record_index")]
    return names, sorted((r["source_file"], r["record_index"], {c: r[c] for c in names}) for r in rows) if rows else []


def check(spark, folder, texts, block):
    names, got = read(spark, folder, texts, block)
    want = sorted((f, i, {c: r.get(c, "") for c in names}) for f, i, r in expected(texts))
    assert got == want, (block, [x for x in zip(got, want) if x[0] != x[1]][:2])


ODD = 'Id, matchId ,note\n"p\n1",m1,3\n\n  "a ""b"", c" ,m2\r\n \nx"y,"la"zy",\'q"\n"q","one\r\n\r\ntwo, ""three""\n",last,more\n p5, "spaced\n out",\n""\nend,"never closed, \n""\n'


@pytest.mark.parametrize("block", [7, 40, 1 << 20])
def test_line_ends_in_quotes_and_lazy_quotes(spark, tmp_path, block):
    check(spark, tmp_path, {"a.csv": ODD, "b.csv": "kills,Id,matchId\n1,p,m\n2,q,n\n", "c.csv": '"kills","ma\ntch",Id\n"5","a\n\n\nb",z\n', "d.csv": "", "e.csv": "Id,Id,note"}, block)


@pytest.mark.parametrize("seed", range(3))
def test_random_files(spark, tmp_path, seed):
    rng = random.Random(seed)
    texts = {f"{n}.csv": "a,b\n" + "".join(rng.choice(['"', '"', "\n", ",", "x", " ", "\r\n", '""', ',"']) for _ in range(300)) for n in range(4)}
    check(spark, tmp_path, texts, rng.choice([5, 16, 64]))


def test_plain_files_need_no_python(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x, ""y"""\n2,z\n')
    df = read_raw_csv(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "ArrowEval" not in plan
    assert sorted((r["a"], r["b"]) for r in df.select("a", "b").collect()) == [("1", 'x, "y"'), ("2", "z")]


def test_long_records_keep_the_stack_flat(spark, tmp_path):
    body = '""q""x ' * 30_000
    (tmp_path / "a.csv").write_text(f'a,b\n1,"{body}\n{body}"\n')
    row = read_raw_csv(spark, str(tmp_path)).select("a", F.length("b").alias("n")).head()
    assert (row["a"], row["n"]) == ("1", len((body + "\n" + body).replace('""', '"').strip()))
