"""What decides on a page's text, on pages that the ratios and the markup judge differently."""

from tallyline.llm.html_paths import main_text

LINE = "The council met on Monday, and after a long debate, it agreed to the plan. Work starts in May, they said. "
MAIN = "".join(f"<p>{LINE * 4}</p>" for _ in range(6))


def test_ratios_decide_where_an_article_is_a_teaser():
    page = f"<body><div><h1>Council</h1>{MAIN}</div><section><article>Next story</article></section></body>"
    text = main_text(page)
    assert text.startswith("Council\nThe council met") and text.count("met on Monday") == 24 and "Next story" not in text


def test_ratios_decide_inside_an_article():
    links = "".join(f"<li><a href=/{i}>Another story, number {i}</a></li>" for i in range(9))
    page = f"<body><article><h1><a href=/>Council</a></h1>{MAIN}<ul>{links}</ul><div>Buy now</div></article></body>"
    text = main_text(page)
    assert text.startswith("Council\nThe council met") and text.count("met on Monday") == 24
    assert "Another story" not in text and "Buy now" not in text


def test_an_article_weighs_more():
    short = "<p>Ten words stand here, no more and also no less.</p>"
    inside, outside = main_text(f"<body><div>{MAIN}</div><article>{short * 2}</article>"), main_text(f"<body><div>{MAIN}</div><section>{short * 2}</section>")
    assert len(inside) >= len(outside) > 0


def test_a_word_of_a_name_does_not_reject_the_text():
    for name in ("class='layout has-sidebar'", "class=post-with-comments", "class='content more'", "id=no-sidebar"):
        text = main_text(f"<body><div {name}><article><h1>Council</h1>{MAIN}</article></div></body>")
        assert text.startswith("Council\nThe council met") and text.count("met on Monday") == 24, name


def test_names_reject_alone_or_where_the_text_agrees():
    links = "".join(f"<a href=/{i}>Another story, number {i}</a> " for i in range(9))
    others = f"<div class='sidebar-home x'>{links}</div><div class='widget-area'><p>{LINE}Widget.</p></div><div class='share-story'><p>Tell your friends</p></div>"
    page = f"<body><div>{MAIN}</div>{others}<article class=comment><p>{LINE}Nonsense!</p></article></body>"
    text = main_text(page)
    assert text.count("met on Monday") == 24 and not any(x in text for x in ("Another", "Widget", "friends", "Nonsense"))


def test_a_long_section_does_not_outweigh_a_real_paragraph():
    long = "".join(f"<p>{('A long sentence of the report, with a comma. ' * 11)[:500]}</p>" for _ in range(10))
    short = "The report has " + "another remark " * 11 + "at its end, and it stops."
    text = main_text(f"<body><div>{long}</div><table><tr><td>{short}<td>{short}<td>{short}</table></body>")
    assert text.count("The report has") == 3 and text.count("A long sentence") > 100
