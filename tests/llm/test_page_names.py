"""Class and id words on what encloses a whole page."""

from rollout_quality.llm import html


def test_page_and_state_names_do_not_hide_the_article():
    article = "<article><p>" + "Plain words of the article stand here. " * 5 + "</p></article>"
    want = ("Plain words of the article stand here. " * 5).strip()
    for page in (
        f"<html class='header'><body class='single sidebar comment'>{article}</body></html>",
        f"<body><div class='single has-sidebar'><div id=with-header class='menu-open'>{article}</div></div>",
    ):
        assert html.main_texts([page + "<div class='site-footer'>c 2020 by us</div><p id=sidebar>More</p>"]) == [want]
