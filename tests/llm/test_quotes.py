"""Partial and short quotations; repeated and clashing turns."""

from muster.llm import quotes

SCHEMA = "conv_id long, turn int, role string, text string"


def linked(spark, rows):
    return quotes.link(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()


def test_partial_and_short_quotations_link(spark):
    got = linked(spark, [
        (1, 0, "u", "Line one.\nLine two."), (1, 1, "a", "Something else here. It goes on\nover lines, yes. Last."), (1, 2, "u", "> Line two.\nok"),
        (1, 3, "a", "> it goes on over lines, yes.\nright"), (1, 4, "u", "Yes, please"), (1, 5, "a", "Other"),
        (1, 6, "u", "> Yes, please\ndone"), (1, 7, "a", "> Line one.\n> Line two.\n\n> nobody wrote this"),
        # the short line is in a later message too, but most of the passage is not
        (2, 0, "u", "Thanks.\nThe long line of the first message.\nMore."), (2, 1, "a", "Thanks."), (2, 2, "a", "Bye."),
        (2, 3, "u", "> Thanks.\n> The long line of the first message.\nok"),
        # who wrote the whole passage comes before who wrote its lines later
        (3, 0, "u", "One two three.\nFour five."), (3, 1, "a", "One two three.\n\nFour five."), (3, 2, "a", "So"), (3, 3, "u", "> One two three. Four five."),
        (4, 0, "u", "> own words quoted"), (4, 1, "a", "later: own words"), (4, 2, "u", "own words quoted"),
    ])
    found = {(r.conv_id, r.turn): (r.parent_turn, r.linked, r.n_quotes) for r in got}
    assert found[1, 2] == (0, True, 1) and found[1, 3] == (1, True, 1)
    assert found[1, 6] == (4, True, 1) and found[1, 7] == (0, True, 2)
    assert found[2, 3] == (0, True, 1) and found[3, 3] == (0, True, 1)
    assert found[4, 0] == (None, False, 1)


def test_repeated_and_clashing_turns(spark):
    rows = [(1, 0, "u", "Hello there friend"), (1, 0, "u", "Hello there friend"), (1, 1, "a", "Aside"),
            (1, 2, "a", "> Hello there friend\nHi"), (1, 2, "a", "> Hello there friend\nHi"),
            (2, 0, "u", "b first line\nb second line"), (2, 0, "u", "a first line\na second line"), (2, 1, "x", "middle"),
            (2, 2, "a", "> b first line\n> b second line\nanswer b"), (2, 2, "a", "> a first line\n> a second line\n\n> middle\nanswer a"),
            (2, 3, None, "end")]
    got = linked(spark, rows)
    assert len(got) == len(rows)
    one = [(r.turn, r.parent_turn, r.linked, r.n_quotes, r.place) for r in got if r.conv_id == 1]
    assert sorted(one) == sorted([(0, None, False, 0, 1)] * 2 + [(1, 0, False, 0, 2)] + [(2, 0, True, 1, 3)] * 2)
    two = {(r.turn, r.text): (r.parent_turn, r.linked, r.n_quotes) for r in got if r.conv_id == 2}
    assert two[2, "answer b"] == (0, True, 1) and two[2, "\nanswer a"] == (1, True, 2)
    assert two[0, "a first line\na second line"] == two[0, "b first line\nb second line"] == (None, False, 0)
    places = {r.place: (r.turn, r.text[:8]) for r in got if r.conv_id == 2}
    assert sorted(places) == [1, 2, 3, 4, 5, 6] and places[1] == (0, "a first ") and places[2] == (0, "b first ")


def test_a_chain_of_quotations_two_turns_back_keeps_linear_state(spark, monkeypatch):
    """Every message answers the one two turns before: each is a run of its own, nested deep."""
    n, sizes = 1500, []
    plain = quotes.cut
    monkeypatch.setattr(quotes, "cut", lambda df: (lambda c: (sizes.append(c.count()), c)[1])(plain(df)))
    tree = spark.createDataFrame([(1, t, t - 1 if t else None, max(t - 2, 0) if t else None) for t in range(n)],
                                 "conv long, turn int, before int, parent int")
    got = {r.turn: r.place for r in quotes._in_reply_order(tree).collect()}
    # 0, 1, then what answers 1, then the other answers of 0
    order = [0, *range(1, n, 2), *range(2, n, 2)]
    assert got == {t: i for i, t in enumerate(order, 1)}
    assert max(sizes) <= 2 * n and len(sizes) < 20


def test_long_groups_are_read_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(quotes, "SPAN", 3)
    rows = [(1, i, i if i in (4, 5, 11) else None) for i in range(1, 20)] + [(2, 1, None), (2, 2, 7)]
    df = quotes._running_max(spark.createDataFrame(rows, "g int, place int, v int"), ["g"], "place", "v", "m")
    want = {(g, p): max((v for h, q, v in rows if h == g and q <= p and v), default=None) for g, p, _ in rows}
    assert {(r.g, r.place): r.m for r in df.collect()} == want


def test_extra_columns_with_clashing_names(spark):
    rows = [(1, 0, "u", "Hello there friend", 9, "x", True), (1, 1, "a", "Aside", 9, "x", True),
            (1, 2, "a", "> Hello there friend\nHi", 9, "x", True), (None, 3, "a", "> Hello", 9, "x", True)]
    docs = spark.createDataFrame(rows, SCHEMA + ", place int, conv string, asks boolean")
    got = quotes.link(docs).collect()
    assert sorted((r.turn, r.parent_turn, r.linked, r.place) for r in got if r.conv_id) == [
        (0, None, False, 1), (1, 0, False, 2), (2, 0, True, 3)]
    assert quotes.link(docs.limit(0)).count() == 0
