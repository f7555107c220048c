from tessera.llm import quotes


def test_parse_levels():
    own, passages = quotes.parse("hello\n> a\n>b\n> > c\n>>d\n> e\nlast\n")
    assert own == "hello\nlast"
    assert passages == [(1, ["a", "b"]), (2, ["c", "d"]), (1, ["e"])]


def messages():
    rows = [
        ("t1", 1, "Shall we meet?\nSecond line", "x"),
        ("t1", 2, "> shall  WE meet?\n> second line\nYes", "x"),
        ("t1", 3, "> > Shall we meet?\n> > Second line\n> Yes\nGreat", "x"),
        ("t1", 4, "> second line\nPartly", "x"),
        ("t1", 5, "> unknown words\nAlone", "x"),
        ("t1", 6, ">> Yes\nDeep only", "x"),
        ("t1", 7, "> Great\n> Yes\nBoth", "x"),
        ("t2", 1, "same", "x"), ("t2", 2, "same", "x"), ("t2", 3, "> same\nanswer", "x"),
        ("t3", 1, None, "x"), ("t3", 2, "", "x"), ("t3", 3, "> \n>  ", "x"),
        ("t4", 1, "twice", "x"), ("t4", 1, "twice", "x"), ("t4", 2, "> twice\nre", "x"),
        (None, 1, "no thread", "x"), ("t5", None, "no order", "x"),
        ("t6", 1, "> later\nfirst", "x"), ("t6", 2, "later", "x"),
        ("t7", 1, "long " * 30_000, "x"), ("t7", 2, "> " + "long " * 30_000 + "\nok", "x"),
    ]
    hot = [("t8", k, ("> hi\n" if k else "") + ("hi" if k < 300 else f"m{k}"), "x") for k in range(600)]
    return rows + hot


def test_links_orders_and_bodies(spark):
    df = spark.createDataFrame(messages(), "conv_id string, turn long, text string, level string").repartition(3)
    out = quotes.link_replies(df, keep=("level",))
    got = {(r.conv_id, r.turn): r for r in out.collect()}
    parents = {k: r.parent for k, r in got.items()}
    assert [parents["t1", k] for k in range(1, 8)] == [None, 1, 2, 1, None, 2, 3]
    assert parents["t2", 3] == 1 and parents["t2", 2] is None
    assert parents["t3", 3] is None and got["t3", 1].body is None and got["t3", 2].body == ""
    assert parents["t4", 2] == 1 and parents["t6", 1] is None and parents["t7", 2] == 1
    assert got[None, 1].depth == 0 and got["t5", None].position == 1
    assert got["t1", 3].body == "Great" and got["t1", 3].depth == 2 and got["t1", 3].root == 1
    assert all(parents["t8", k] == 0 for k in range(1, 600))
    for key, r in got.items():
        if r.parent is not None:
            up = got[key[0], r.parent]
            assert up.position < r.position and up.depth == r.depth - 1 and up.root == r.root
    assert out.count() == len(messages())


def test_conversations_hold_every_message_in_order(spark):
    df = spark.createDataFrame(messages()[:10], "conv_id string, turn long, text string, role string")
    talks = {(r.conv_id, r.root): [m.text for m in r.messages] for r in quotes.conversations(quotes.link_replies(df)).collect()}
    assert talks["t1", 1] == ["Shall we meet?\nSecond line", "Yes", "Partly", "Great", "Deep only", "Both"]
    assert sum(map(len, talks.values())) == 10
    assert quotes.link_replies(df.limit(0)).collect() == []


def test_deep_chain(spark):
    rows = [("c", k, (f"> m{k - 1}\n" if k else "") + f"m{k}") for k in range(300)]
    out = quotes.link_replies(spark.createDataFrame(rows, "conv_id string, turn long, text string"), keep=())
    assert sorted((r.turn, r.depth, r.position, r.root) for r in out.collect()) == [(k, k, k + 1, 0) for k in range(300)]


def test_copies_share_links_and_places(spark):
    """A chain stored twice, one message stored 40 times, and two texts under one order number."""
    chain = [("c", k, (f"> m{k - 1}\n" if k else "") + f"m{k}", role) for k in range(3) for role in ("a", "b")]
    hot = [("h", 1, "q", "a")] * 40 + [("h", 2, "> q\nre", "a")]
    torn = [("d", 1, "one", "a"), ("d", 1, "two", "a"), ("d", 1, None, "a"), ("d", 2, "> one\nre", "a")]
    df = spark.createDataFrame(chain + hot + torn, "conv_id string, turn long, text string, role string").repartition(4)
    out = quotes.link_replies(df).collect()
    assert len(out) == len(chain + hot + torn)
    c = sorted((r.position, r.turn, r.parent, r.depth, r.root) for r in out if r.conv_id == "c")
    assert c == [(1, 0, None, 0, 0), (2, 0, None, 0, 0), (3, 1, 0, 1, 0), (4, 1, 0, 1, 0), (5, 2, 1, 2, 0), (6, 2, 1, 2, 0)]
    assert sorted(r.role for r in out if r.conv_id == "c") == ["a"] * 3 + ["b"] * 3
    h = sorted((r.position, r.turn, r.parent) for r in out if r.conv_id == "h")
    assert h == [(k, 1, None) for k in range(1, 41)] + [(41, 2, 1)]
    assert all((r.parent, r.position, r.depth) == (None, 1, 0) for r in out if r.conv_id == "d")
