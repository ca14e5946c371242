from palimpsest.functions.pages import as_dict, decode, from_dict, main_text, tree, walk


def flat(html):
    return [n.text for n, _ in walk(tree(html))]


def passages(html):
    from palimpsest.functions.pages import joint

    return [c + joint(c) + n.text for n, c in walk(tree(html))]


def test_heading_order_is_by_section():
    # the second heading goes under the first, before the division that stands between
    assert flat("<body><h1>A</h1><div><p>x</p></div><h2>B</h2></body>") == ["A", "B", "x"]


def test_paragraph_after_division_is_its_child():
    t = tree("<body><div>one</div><p>two</p></body>")
    div = t.children[0].children[0]
    assert [c.text for c in div.children] == ["one", "two"]


def test_context_walk():
    assert passages("<body><h1>Title</h1><p>First.</p><p>Second</p></body>") == ["Title", "Title.\nFirst.", "Title.\nSecond"]
    assert passages("<div>raw<p>x</p></div>") == ["raw", "raw.\nx"]


def test_skipped_and_flattened():
    html = "<body><script>s</script><footer>f</footer><ul><li>a <b>b</b></li></ul><table><thead>h</thead><tr><td>c</td></tr></table></body>"
    assert flat(html) == ["a b", "h", "c"]


def test_text_is_escaped_and_collapsed():
    assert flat("<p>A &amp; B\n  &lt;c&gt;</p>") == ["A &amp; B &lt;c&gt;"]


def test_tree_round_trip():
    t = tree("<body><h1>A</h1><p>b</p></body>")
    assert as_dict(from_dict(as_dict(t))) == as_dict(t)
    assert as_dict(t)["size"] == 4 and as_dict(t)["depth"] == 4


def test_empty():
    assert flat("") == [] and flat("<body></body>") == []


def test_main_text():
    got = main_text("<html><body><nav>n</nav><main><p>keep<b>bold</b></p><script>s</script></main></body></html>")
    assert "keep\n" in got and "bold" in got and "s" in got and "n" not in got.replace("main", "").split()
    got = main_text('<body><div class="x ad">buy</div><aside>a</aside><p>text</p><style>q</style></body>')
    assert "text" in got and "buy" not in got and "<aside>" not in got
    assert main_text(None) is None


def test_decode():
    assert decode("“x”".encode("cp1252"), "text/html; charset=windows-1252") == ("“x”", "windows-1252")
    assert decode(b"\xe9", 'text/html; charset="iso-8859-1"') == ("é", "iso-8859-1")
    assert decode(b"\xff\xfe\x81", None)[0].startswith("�") and decode(b"ab", None) == ("ab", "utf-8")
    assert decode(b"a", "text/html; charset=nonsense") == ("a", "nonsense")
    assert decode(None, None) == (None, None)


def test_deep_and_flat_pages():
    """Neither nesting nor many siblings cost more than their number; the walk keeps the order."""
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert flat(deep) == ["x"] and tree(deep).depth() == 5002 and "x" in main_text(f"<main>{deep}</main>")
    wide = tree("".join(f"<p>{k}</p>" for k in range(20_000)))
    assert [n.read_idx() for n, _ in walk(wide)] == list(range(20_000))
    assert wide.find(777).text == "777" and wide.find(30_000) is None
