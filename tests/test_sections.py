from markloom.functions import sections as S

PAGE = "lead\n== A ==\na\n=== B ===\nb\n==C==\nc\n"


def test_flat_sections(apply):
    got = apply(S.sections, PAGE)
    assert [(s.level, s.heading, s.body) for s in got] == [
        (0, None, "lead\n"),
        (2, "a", "== A ==\na\n"),
        (3, "b", "=== B ===\nb\n"),
        (2, "c", "==C==\nc\n"),
    ]


def test_heading_shapes(apply):
    cases = {
        "== a ===\n": (2, "a ="),
        "=== a ==\n": (2, "= a"),
        "====== x ======": (6, "x"),
        "= x =  \n": (1, "x"),
        "==x\n": (0, None),
        "x ==\n": (0, None),
        "== a == b\n": (0, None),
    }
    got = apply(S.sections, *cases)
    assert [(s[0].level, s[0].heading) for s in got] == list(cases.values())


def test_level2_loses_what_belongs_nowhere(apply):
    cases = {
        PAGE: ["lead\n", "== A ==\na\n=== B ===\nb\n", "==C==\nc\n"],
        "no headings": ["no headings"],
        "": [""],
        "== A ==\nx": ["", "== A ==\nx"],
        "l\n=== O ===\nlost\n== A ==\nx": ["l\n", "== A ==\nx"],
        "=== O ===\nlost\n== A ==\nx": ["", "== A ==\nx"],
        "l\n== A ==\nx\n= T =\nlost\n=== D ===\nlost\n== B ==\ny": ["l\n", "== A ==\nx\n", "== B ==\ny"],
        "= T =\nlost": [""],
    }
    assert apply(S.level2, *cases) == list(cases.values())


def test_nested_and_flat_removal(apply):
    page = "l\n== References ==\nr\n=== Citations ===\nc\n=== Kept ===\nk\n== After ==\na\n"
    assert apply(S.drop_sections, page) == "l\n== After ==\na\n"
    flat = apply(lambda c: S.drop_sections(c, nested=False), page)
    assert flat == "l\n\n\n=== Kept ===\nk\n\n\n== After ==\na\n"


def test_removal_depends_on_the_level(apply):
    cases = {
        "l\n== A ==\n=== Notes ===\nn\n==== X ====\nx\n=== B ===\nb\n": "l\n== A ==\n=== B ===\nb\n",
        "== NOTES ==\nn\n= Top =\nt\n": "= Top =\nt\n",
        "==\xa0Notes\u2003==\nn": "",
        "== Notes on x ==\nn": "== Notes on x ==\nn",
    }
    assert apply(S.drop_sections, *cases) == list(cases.values())


def test_join(apply):
    assert apply(lambda c: S.join_sections(S.level2(c)), PAGE) == (
        "lead\n\n\n== A ==\na\n=== B ===\nb\n\n\n==C==\nc\n"
    )
    assert apply(S.join_flat, "a\n== B ==\nc") == "a\n\n\n== B ==\nc"
    assert apply(S.finish, " \n a \u3000") == "a\n"


def test_removed_section_first_takes_only_itself(apply):
    cases = {
        "== References ==\nx\n== Body ==\nbody": "== Body ==\nbody",
        "=== Sources ===\nx\n== Body ==\nbody": "== Body ==\nbody",
        "== Body ==\nb\n=== References ===\nx\n==== Deep ====\ny\n=== Kept ===\nz": "== Body ==\nb\n=== Kept ===\nz",
        "== References ==\nx\n=== Below ===\ny\n= Top =\nz": "= Top =\nz",
        "== References ==\nx": "",
    }
    assert apply(S.drop_sections, *cases) == list(cases.values())


def test_only_levels_with_a_named_heading_are_cut(apply):
    from pyspark.sql import functions as F

    # One look for the whole text and one for each level.
    assert str(S.drop_sections(F.col("t"), ["notes"])).count("rlike(") == 7
    cases = {
        "a\n== Notes ==\nb\n=== c ===\nd\n== e ==\nf\n": "a\n== e ==\nf\n",
        "a\n=== notes==\nb\n=== Notes ===\nc\n== d ==\n": "a\n=== notes==\nb\n== d ==\n",
        "===== x =====\n= NOTES =\ny\n====== notes ======\nz": "===== x =====\n",
        "== Notes\n== x ==\n": "== Notes\n== x ==\n",
    }
    assert apply(lambda c: S.drop_sections(c, ["notes"]), *cases) == list(cases.values())
    # A Kelvin sign is a k in lower case.
    assert apply(lambda c: S.drop_sections(c, ["links"]), "=== x ===\n== links ==\na\n= lin\u212as =\nb\n") == "=== x ===\n"
