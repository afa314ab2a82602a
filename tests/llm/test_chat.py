from barlake.llm import chat as C

SCHEMA = "conv_id long, turn long, role string, text string, part long, speaker string"


def brute(rows):
    convs = {}
    for c, t, r, x, *_ in set(rows):
        convs.setdefault(c, []).append((t is None, t or 0, r is None, r or "", x or ""))
    out = []
    for c, turns in convs.items():
        turns = sorted(set(turns))
        for s in {t[3] for t in turns if not t[2] and t[3] != "system"}:
            text, mask = "", []
            for _, _, none, r, x in turns:
                who = "user name=unknown" if none else "assistant" if r == s else "system" if r == "system" else "user name=" + r
                text += f"<|im_start|>{who}\n"
                if not none and r == s:
                    mask.append((len(text), len(text) + len(x) + 11))
                text += f"{x}<|im_end|>\n"
            out.append((c, s, len(turns), text, mask))
    return sorted(out, key=str)


def run(spark, rows, **more):
    return C.rotate_perspectives(spark.createDataFrame(rows, SCHEMA).repartition(3), **more).collect()


def test_equals_brute_force(spark):
    rows = [(1, 0, "system", "be nice", None, None), (1, 1, "ann", "hi 🙂", 1, "x"), (1, 2, "bob", "é", None, None), (1, 3, "carl", None, None, None), (1, 4, "ann", "", None, None),
            (2, 0, "system", "alone", None, None), (3, 5, "ann", "b", None, None), (3, 5, "ann", "a", None, None), (3, 5, "bob", "a", None, None), (3, 4, None, "who", None, None),
            (None, 0, "ann", "null conv", None, None), (None, 1, "bob", "null conv", None, None)] + [(4, 0, "ann", "same", None, None)] * 4
    got = sorted(((r.conv_id, r.speaker, r.n_turns, r.text, [(m.start, m.end) for m in r.mask]) for r in run(spark, rows)), key=str)
    assert got == brute(rows)
    for r in run(spark, rows):
        assert r.n_own == len(r.mask) and all(r.text[m.start:m.end].endswith(C.CLOSE) for m in r.mask)


def test_hot_conversation_is_cut_into_bounded_parts(spark):
    rows = [(9, i, f"p{i % 3}", f"t{i}", None, None) for i in range(1000)] + [(9, None, "p1", f"late {i}", None, None) for i in range(300)]
    got = run(spark, rows, part_turns=100)
    assert max(r.n_turns for r in got) <= 160 and {r.speaker for r in got} == {"p0", "p1", "p2"}
    for s in ("p0", "p1", "p2"):
        mine = sorted((r for r in got if r.speaker == s), key=lambda r: (r.part, r.sub_part))
        assert sum(r.n_turns for r in mine) == 1300
        text = "".join(r.text for r in mine if r.part >= 0)
        assert [f"t{i}{C.CLOSE}" in text for i in range(1000)] == [True] * 1000
        assert sum(r.n_own for r in mine) == sum(x[2] == s for x in rows)


def test_empty(spark):
    assert run(spark, []) == []


def test_parts_are_consecutive_and_start_with_the_system_turns(spark):
    rows = [(1, 0, "system", "be nice", None, None), (1, 120, "system", "be brief", None, None)] + [(1, i, f"p{i % 2}", f"t{i:03d}", None, None) for i in range(1, 250)]
    rows += [(1, None, "p0", f"u{i:03d}", None, None) for i in range(250)]
    got = [r for r in run(spark, rows, part_turns=100) if r.speaker == "p0"]
    got.sort(key=lambda r: (r.part < 0, r.part, r.sub_part))
    bodies = [[b.split("\n", 1) for b in r.text.replace(C.OPEN, "").split(C.CLOSE)[:-1]] for r in got]
    assert [x for b in bodies for h, x in b if h != "system"] == [f"t{i:03d}" for i in range(1, 250)] + [f"u{i:03d}" for i in range(250)]
    heads = [[x for h, x in b if h == "system"] for b in bodies]
    assert heads[0] == ["be nice"] and all(h == ["be nice", "be brief"] for h in heads[1:])
    assert all(b[0] == ["system", "be nice"] for b in bodies) and sum(r.n_turns for r in got) == len(rows)
    assert all(r.text[m.start:m.end].endswith(C.CLOSE) for r in got for m in r.mask)


def test_rows_do_not_depend_on_the_join_chosen(spark, monkeypatch):
    """Long instructions and ids, once with every side table broadcast and once with none."""
    wide = "conv_id string, turn long, role string, text string"
    rows = [(c, i * 30, "system", f"rule {i} " + "x" * 2000) for c in ("a" * 300, "b") for i in range(6)]
    rows += [(c, i, f"p{i % 2}", f"t{i}") for c in ("a" * 300, "b") for i in range(200)] + [(None, 3, "p0", "alone")]
    runs = []
    for bound in (1 << 30, 0):
        monkeypatch.setattr(C, "BROADCAST_BYTES", bound)
        runs.append(sorted(map(str, C.rotate_perspectives(spark.createDataFrame(rows, wide).repartition(3), part_turns=50).collect())))
    assert runs[0] == runs[1] and len(runs[0]) > 8
