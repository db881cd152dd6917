from tickforge.llm import html_nodes


def test_siblings_of_a_tag_are_counted_at_every_size():
    for n in (10, 80):
        nodes = html_nodes.read("<article>" + "<p>Some words of a text.</p>" * n + "<div>Advert</div></article>")
        alike = {x.tag: row[-6] for x, row in zip(nodes, html_nodes.features(nodes), strict=True) if x.tag in ("p", "div")}
        assert alike == {"p": n, "div": 1}


def test_text_of_formulas_and_media_stays():
    page = "<article><p>Mass <math><mi>m</mi><mo>=</mo><mn>3</mn></math> and <svg><path d='M0'/><text>label</text></svg>, <object>fallback</object>.</p><noscript><p>plain</p></noscript><iframe>never</iframe></article>"
    text = [x for n in html_nodes.read(page) for _, x in n.runs]
    assert text == ["Mass m=3 and label, fallback.", "plain"]
