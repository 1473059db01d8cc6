import math
import random
import re
from collections import Counter

import regex

import corpus_pipeline as P
from tallyfold.llm import line_dedup, mixing, pieces
from tallyfold.llm.quality_rules import REFERENCES
from tests.llm import test_line_dedup, test_mixing, test_quality_rules, test_simhash
from tests.llm.rows import DOCS, awkward_docs, no_docs


def test_the_last_stage_tells_what_does_not_come_back(spark, monkeypatch):
    docs = awkward_docs(spark)
    assert [r["lossless"] for r in P.encoded(spark, docs, "").collect()] == [True] * docs.count()
    whole = pieces.encode
    monkeypatch.setattr(pieces, "encode", lambda *a, **b: whole(*a, **b).selectExpr("* except (decoded)", "substring(decoded, 2) as decoded"))
    few = docs.filter("doc_id = 4")
    assert [r["lossless"] for r in P.encoded(spark, few, "").collect()] == [False]


# The stages in plain Python, over lists of (doc_id, text, lang, source).


def js(p, q):
    p, q = ([x / sum(h) if sum(h) else 0.0 for x in h] for h in (p, q))
    part = lambda x, m: x * math.log2(x / m) if x else 0.0
    return math.sqrt(max(0.0, sum((part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2 for a, b in zip(p, q))))


def kept_by_rules(text, lang):
    text = text or ""
    n_words, _, n_symbols, _, n_repeat, *_ = test_quality_rules.base(text)
    if n_words < 50 or 100 * n_repeat > 50 * n_words:
        return False
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    signs = regex.findall(r"[^\p{L}\x20\x09-\x0D]", text)
    upper, letters = len(regex.findall(r"\p{Lu}", text)), len(regex.findall(r"\p{L}", text))
    digits = sum(c in "0123456789" for c in signs)
    marks = sum(c in ".,;:!?'\"()[]{}¿¡«»„“”‘’…-–—/" for c in signs)
    classes = (
        upper, letters - upper, digits, len(text) - sum(map(len, words)), marks, n_symbols,
        len(signs) - digits - marks - n_symbols,
    )
    counts = Counter(words)
    chars, common = [], []
    for ref in [REFERENCES[lang]] if lang in REFERENCES else REFERENCES.values():
        met = [counts[w] for w in ref["words"]]
        shares = list(ref["words"].values())
        chars.append(js(classes, ref["chars"]))
        common.append(js([*met, n_words - sum(met)], [*shares, 1000 - sum(shares)]))
    far = min(chars) if len(text) >= 200 else 0.0
    odd = min(common) if n_words >= 100 else 0.0
    return not (far > 0.30 or odd > 0.38 or (far > 0.15 and odd > 0.30))


def plain_lines(rows):
    key = test_line_dedup.key
    own = lambda row: line_dedup.NO_ID if row[0] is None else row[0]
    holders = {}
    for at, row in enumerate(rows):
        for k in {key(x) for x in row[1].split("\n")}:
            if len(k) >= 20:
                holders.setdefault(k, {})[at] = own(row)
    last = {k: max(h.values()) for k, h in holders.items() if len(h) >= 3}
    out = []
    for row in rows:
        left = [x for x in row[1].split("\n") if last.get(key(x), own(row)) == own(row)]
        if left:
            out.append((row[0], "\n".join(left), *row[2:]))
    return out


def plain_groups(rows):
    root = test_simhash.roots([test_simhash.plain(r[1]) for r in rows], 4)
    heads = {}
    for row in rows:
        group = root[test_simhash.plain(row[1])]
        heads[group] = min(heads.get(group, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    return list(heads.values())


def plain_mixture(rows):
    path = lambda row: (mixing.DOMAINS.get(row[3], "other"), row[2], row[3])
    counted = [(row[0], path(row), len(re.findall(r"[^\x20\x09-\x0D]+", row[1]))) for row in rows]
    taken = Counter((d, p) for d, p, _, _ in set(test_mixing.brute(counted, 100, mixing.WEIGHTS, 2, 17)))
    return [row for row in rows for _ in range(epochs_of(taken, row, path(row), rows))]


def epochs_of(taken, row, path, rows):
    """Rows of one id in one leaf are taken together; ``taken`` knows them by their sizes."""
    sizes = {len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in rows if r[0] == row[0] and r[2:] == row[2:]}
    return taken[str(row[0]), path] // len(sizes)


def corpus():
    rng = random.Random(21)
    common = {lang: list(ref["words"]) for lang, ref in REFERENCES.items()}
    own = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9)))

    def prose(n, lang):
        return " ".join(rng.choice(common.get(lang, common["en"])) if rng.random() < 0.4 else own() for _ in range(n))

    licence = "this licence line stands in many documents of the corpus"
    rows = []
    for i in range(60):
        lang = ("en", "en", "de", "fr", "es", None, "xx")[i % 7]
        parts = [prose(rng.randint(15, 120), lang).capitalize() + "." for _ in range(rng.randint(1, 4))]
        if i % 4 == 0:
            parts.insert(rng.randrange(len(parts) + 1), f"  {licence.upper() if i % 8 else licence} ")
        rows.append((100 + i, "\n".join(parts), lang, None if i % 9 == 0 else f"src{i % 6 * i % 20}"))
    copies = [(200 + i, rows[i][1], *rows[i + 1][2:]) for i in range(0, 12, 2)]
    near = [(300 + i, rows[i][1] + " " + own(), *rows[i][2:]) for i in range(20, 30)]
    nameless = [(None, prose(150, "en"), "en", "src0") for _ in range(4)] + [(None, prose(120, None), None, None)]
    twice = [(400, prose(160, "en"), "en", "src3"), (400, prose(90, "en"), "en", "src3"), (401, rows[5][1], "de", "src1"), (401, rows[5][1], "de", "src1")]
    whole = "\n".join([licence] + [rows[0][1].split("\n")[0]])
    emptied = [(i, licence + "\n" + "\n".join(f"{licence} and number {k} of the long list of lines" for k in range(9)), "en", "src2") for i in (10, 11, 12)]
    junk = [(500, "#$% " * 80, "en", "src0"), (501, "", "en", "src0"), (502, None, None, None), (503, "word " * 300, "en", "src1"), (504, whole, "en", "src1")]
    far = [(600, " ".join(own() for _ in range(400)), "en", "src4"), (601, " ".join(str(rng.randrange(10**9)) for _ in range(90)), "fr", "src4")]
    out = rows + copies + near + nameless + twice + emptied + junk + far
    rng.shuffle(out)
    return out


def content(frame):
    return Counter((r["doc_id"], r["text"], r["lang"], r["source"]) for r in frame.collect())


def test_stages_and_run_equal_brute_force(spark, tmp_path):
    rows = corpus()
    frame = spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in rows], DOCS)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    docs, model = spark.read.parquet(f"{tmp_path}/documents.parquet"), pieces.PieceModel(pieces.read_model())
    wanted = [[r for r in rows if kept_by_rules(r[1], r[2])]]
    for plain in (plain_lines, plain_groups, plain_mixture):
        wanted.append(plain(wanted[-1]))
    # Every stage has something to do.
    assert 60 < len(wanted[0]) < len(rows)
    assert len(wanted[1]) < len(wanted[0]) and {r[1] for r in wanted[1]} - {r[1] for r in wanted[0]}
    assert len(wanted[2]) < len(wanted[1]) and len(set(wanted[3])) < len(wanted[3])
    assert sum(r[0] is None for r in wanted[2]) == 5
    for (name, stage), want in zip(P.STAGES, wanted):
        docs = P.cut(stage(spark, docs, str(tmp_path)), "brute-" + name.replace(" ", "-"))
        assert docs.columns == frame.columns
        assert content(docs) == Counter(want), name
        if name != "quality rules":
            assert docs.filter("n_chars <> length(text)").count() == 0
    for last in (P.STAGES[-1][1](spark, docs, str(tmp_path)), P.run(spark, str(tmp_path))):
        found = last.collect()
        assert all(r["lossless"] and r["n_pieces"] == len(r["pieces"]) for r in found)
        assert Counter((r["doc_id"], model.decode(r["pieces"]), r["lang"], r["source"]) for r in found) == Counter(wanted[-1])


def test_no_rows(spark, tmp_path):
    no_docs(spark).write.parquet(f"{tmp_path}/documents.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
