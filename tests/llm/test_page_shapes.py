"""Shapes of pages whose article lies where menus and notices often do."""

import pytest

from quillspan.llm.html_text import main_text

LONG = " ".join(f"Sentence {i} of the article says something." for i in range(12))


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><form action=x><div><h1>Title</h1><p>{LONG}</p></div><input name=q><button>Go</button></form></body>", f"Title {LONG}"),
        (f"<body><form><input> Search this site</form><div><p>{LONG}</p></div></body>", LONG),
        (f"<body><header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{LONG}</p></article></body>", f"Title {LONG}"),
        (f"<body><header><div><p>{LONG}</p></div></header></body>", LONG),
        (f"<body><main><p>{LONG}</p><table class='widget'><tr><td>cell</td></tr></table></main></body>", f"{LONG} cell"),
        (f"<body><main><p>{LONG}</p><ul class='search-results'><li>found</li></ul></main></body>", f"{LONG} found"),
        (f"<body><article><p id='reply-header'>Hello.</p><p>{LONG}</p></article></body>", f"Hello. {LONG}"),
        (f"<body><article><p>{LONG}</p><p class='advert'>Buy!</p><ul class='share-links'><li>Share</li></ul><div class='comments'><p>Nice post</p></div></article></body>", LONG),
        (f"<body><article><p>{LONG}</p><aside>See also</aside><form>Your mail</form></article></body>", LONG),
    ],
)
def test_the_article_is_found(page, text):
    assert main_text(page) == text
