"""Main text that stands beside the best container, and random trees of blocks with marked ones in between."""

import random

import pytest

from skyweave.llm.html_text import main_text

LONG = "alpha, beta, gamma and a sentence of some length, which goes on, and on, until it ends."


@pytest.mark.parametrize(("page", "want"), [
    (f"<body><div class=hero><h1>Title</h1></div><div class=text><p>{LONG}</p><p>{LONG}</p></div>", f"Title\n{LONG}\n{LONG}"),
    (f"<body><div class=page><div class=t>Title</div><div class=l>Lead text here</div><div class=b><p>{LONG}</p><p>{LONG}</p></div></div>", f"Title\nLead text here\n{LONG}\n{LONG}"),
    (f"<body><div id=content><div class=sec><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div class=sec><p>beta, gamma</p></div></div>", f"{LONG}\n{LONG}\n{LONG}\nbeta, gamma"),
    (f"<body><div><p>{LONG}</p><p>{LONG}</p></div><ul><li>item one</li><li>item two</li></ul>", f"{LONG}\n{LONG}\nitem one\nitem two"),
    (f"<article><p>{LONG}</p><section class=related-work><p>kept, too</p></section><div class=share-price>42</div><div class=comment-free>free</div></article>", f"{LONG}\nkept, too\n42\nfree"),
    (f"<article><p>see <span class='search'>found words</span> here, {LONG}</p></article>", f"see found words here, {LONG}"),
    (f"<body><div><p>a <label for=x>labelled</label> word, {LONG}</p></div>", f"a labelled word, {LONG}"),
    (f"<article><p>{LONG}</p><div class=comment-list><p>gone, gone</p></div><div class=share-buttons>gone</div><div class=related-posts><p>gone, gone</p></div></article>", LONG),
    (f"<body><div class=x><a href=/>Home</a> <a href=/b>B</a></div><div><p>{LONG}</p></div><div>&copy; 2020</div><ul><li><a href=/c>c</a></ul>", LONG),
])
def test_text_around_the_best_container(page, want):
    assert main_text(page) == want


def test_random_trees():
    """Sections, divs and lists at random depth, with marked blocks in between that have to go."""
    rng = random.Random(12)
    gone = ["<div class=sidebar><p>gone, gone</p></div>", "<nav><ul><li><a href=/>gone</a></ul></nav>", "<div class='ad banner'>gone, gone</div>", "<aside><p>gone</p></aside>", "<form><p>gone <input></p></form>", "<div class=comments><p>gone, gone, gone</p></div>", "<div style='display:none'><p>gone</p></div>"]

    def build(depth, want):
        parts = []
        for _ in range(rng.randint(1, 4)):
            kind = rng.choice(["p", "p", "h2", "ul", "div", "section"] if depth < 4 else ["p", "h2"])
            if rng.random() < 0.25:
                parts.append(rng.choice(gone))
            if kind in ("div", "section"):
                parts.append(f"<{kind} class=c{rng.randint(0, 9)}>{build(depth + 1, want)}</{kind}>")
            elif kind == "ul":
                items = [f"item {rng.randint(0, 999)}" for _ in range(rng.randint(1, 3))]
                want += items
                parts.append("<ul>" + "".join(f"<li>{x}" for x in items) + "</ul>")
            else:
                text = f"head {rng.randint(0, 999)}" if kind == "h2" else " ".join(rng.choice(["alpha,", "beta", "gamma"]) for _ in range(rng.randint(8, 60)))
                want.append(text)
                parts.append(f"<{kind}>{text}</{kind}>")
        return "".join(parts)

    for i in range(300):
        want = []
        body = build(0, want)
        around = [f"<body>{body}", f"<body><div class=site-header>gone</div><div class=wrap>{body}</div><footer>gone</footer>", f"<body><header><p>gone</p></header><article>{body}</article>"][i % 3]
        assert main_text(around) == "\n".join(want), around
