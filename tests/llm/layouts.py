"""Pages of unlike layouts, labelled by hand: html, and what of it is main text."""

A = "The council met on Tuesday to decide what becomes of the old bridge over the river."
B = "Most members spoke for a repair, though nobody could say who would pay for all of it."
C = "A vote is expected after the summer, when the engineers have looked at the pillars again."
D = "Until then lorries have to take the long way round by the northern road."
MENU = "<a href=/>Home</a> <a href=/n>News</a> <a href=/s>Sport</a>"

LAYOUTS = {
    "bare": (f"<html><body><p>{A}</p><p>{B}</p></body></html>", [A, B]),
    "bare, title": (f"<html><body><h1>The bridge</h1><p>{A}</p><p>{B}</p><p>{C}</p></body></html>", ["The bridge", A, B, C]),
    "no elements": (A, [A]),
    "article": (f"<body><nav>{MENU}</nav><article><h1>The bridge</h1><p>{A}</p><p>{B}</p></article><footer>All rights reserved</footer></body>", ["The bridge", A, B]),
    "table": (f"<body><table><tr><td>{MENU}</td></tr><tr><td><p>{A}</p><p>{B}</p><p>{C}</p></td></tr></table></body>", [A, B, C]),
    "content": (f"<body><ul class=menu><li><a href=/>Home</a><li><a href=/n>News</a></ul><div id=content><h2>The bridge</h2><p>{A}</p><p>{B}</p></div><div id=foot><p>Privacy</p></div></body>", ["The bridge", A, B]),
    "respond": (f"<body><main><p>{A}</p><p>{B}</p><p>{C}</p></main><section id=respond><p>I do not think so at all.</p><p>Nor do I, it was never safe.</p></section></body>", [A, B, C]),
    "foot": (f"<body><div class=header>The Daily</div><div class=post><p>{A}</p><p>{B}</p></div><div id=foot><p>We respect your privacy and use little of your data.</p></div></body>", [A, B]),
    "sidebar": (f"<body><div class=sidebar><p>Most read this week</p><ul><li><a href=1>A storm</a><li><a href=2>A fair</a></ul></div><div class=main><p>{A}</p><p>{C}</p><p>{D}</p></div></body>", [A, C, D]),
    "list": (f"<body><header><a href=/>Site</a></header><article><p>{A}</p><ul><li>Repair the pillars</li><li>Close one lane</li></ul><p>{D}</p></article></body>", [A, "Repair the pillars", "Close one lane", D]),
    "quote": (f"<body><main><p>{A}</p><blockquote><p>{B}</p></blockquote><p>{C}</p></main><aside><p>Read more of this</p></aside></body>", [A, B, C]),
    "cookie": (f"<body><div class='cookie banner'><p>We use cookies to make this site work.</p><button>Accept</button></div><div class=entry><p>{A}</p><p>{B}</p></div></body>", [A, B]),
    "form": (f"<body><article><p>{A}</p><p>{D}</p></article><form><label>Your mail</label><p>Get our letter every week</p><button>Send</button></form></body>", [A, D]),
    "advert inside": (f"<body><article><p>{A}</p><div class=ad><p>Buy now and save a lot</p></div><p>{B}</p><p>{C}</p></article></body>", [A, B, C]),
    "comments inside": (f"<body><article><h1>The bridge</h1><p>{A}</p><p>{B}</p><div class=comments><div class=comment><p>First of all, thank you for this report.</p></div></div></article></body>", ["The bridge", A, B]),
    "breaks": (f"<body><div>{A}<br>{B}<br><br>{C}</div></body>", [f"{A} {B} {C}"]),
    "only a menu": (f"<body><nav><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul></nav></body>", []),
    "old footer": (f"<body><div id=page><div class=navbar>{MENU}</div><div class=story><p>{A}</p><p>{B}</p><p>{C}</p></div><div class=footer>About us</div></div></body>", [A, B, C]),
}
