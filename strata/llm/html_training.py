"""The labelled table that the block classifier of ``html_extract`` is fitted on.

Small hand-written pages in common layouts. An element marked ``data-main``
holds main text, ``data-not`` inside it does not; the marks give each block its
label and are seen by nothing else.
"""

PAGES = [
    # News page: menus around an article with a figure, notices and comments.
    """<body><header><a href="/">The Daily Stone</a><p>Independent since 1921</p></header>
    <nav><ul><li><a href="/w">World</a></li><li><a href="/b">Business and markets</a></li><li><a href="/s">Sport</a></li></ul></nav>
    <div class="cookie-notice">We use cookies to improve your visit. <a href="/p">Read our policy</a> or accept all cookies now.</div>
    <article data-main><h1>Bridge reopens after long repair</h1><p>The old bridge across the river was opened again
    on Monday, two years after a flood had torn away its middle arch and closed the road to the northern villages.</p>
    <p>It was about time.</p><p>Engineers had to replace forty metres of masonry, see <a href="/r">the full report</a>, and
    said the new arch should hold for at least a century if it is looked after as planned.</p><p>Yes.</p>
    <aside data-not><h3>More on this</h3><a href="/1">Flood of the century</a><a href="/2">Who pays for old bridges</a></aside>
    <div class="ad" data-not>Shoes at half price, this week only in all our shops and on the web.</div>
    <p>Traffic lights will remain until the end of May. Buses return to their old route on Friday.</p></article>
    <section id="comments"><h2>Comments</h2><div class="comment"><p>I drove over it this morning and have to say it looks
    just as good as it did when I was a child, well done to everyone who worked on it.</p></div><div class="comment">First!</div></section>
    <footer>&copy; The Daily Stone. All rights reserved. No part of this site may be copied without our written leave.</footer></body>""",
    # Plain page of advert, article and footer, with one-line paragraphs.
    """<nav><ul><li><a href="/a">Start</a></li><li><a href="/b">Next</a></li></ul></nav><div class="ad">Buy two and pay
    for one until Sunday evening.</div><article data-main><h1>Notes</h1><p>Short one.</p><p>Another | row | of | cells |</p>
    <p>End.</p><p>A sentence of some length that goes on for a while and says very little indeed.</p></article>
    <footer>&copy; www.site.example &middot; Made with care in a small town by the sea.</footer>""",
    # Blog post without semantic elements.
    """<div id="header"><h1><a href="/">A cook's notebook</a></h1></div><div id="menu"><a href="/1">Home</a> <a href="/2">Soups</a>
    <a href="/3">Bread and cakes</a></div><div class="post" data-main><h2>Barley soup</h2><p>Soak the barley overnight, then let it
    simmer with two carrots and an onion for the better part of an hour, until the grains are soft but not yet falling apart.</p>
    <p>Salt late.</p><ul><li>200 g pearl barley</li><li>two carrots</li><li>one large onion, cut fine</li></ul>
    <p>It keeps for three days and is better on the second, when the barley has drunk most of the broth.</p></div>
    <div id="sidebar"><h3>About me</h3><p>I have been cooking for my family of six for thirty years and write down here
    whatever they asked for more than once.</p><ul><li><a href="/x">Older posts</a></li></ul></div>
    <form><label>Your address</label><p>Get a new recipe every Sunday by mail, free of charge, and stop whenever you like.</p></form>
    <div class="footer">Powered by a cat. <a href="/i">Imprint</a></div>""",
    # Bare page: nothing but paragraphs, links and tables.
    """<p><a href="/">Index</a> | <a href="/n">Next chapter</a> | <a href="/p">Previous chapter</a></p>
    <p data-main>In the beginning there was only the harbour and a row of sheds, in which the nets were dried and mended
    through the winter by whoever had no place on the boats that year.</p>
    <p data-main>Nobody remembers who built the first house of stone, but it stands where the road bends away from the shore,
    and its cellar still floods with every spring tide.</p>
    <p data-main>My grandmother was born there. She spoke of the noise of the chains, and of the smell of tar that came
    through the floor in the summer months when they caulked the hulls.</p>
    <p><a href="/">Index</a> | <a href="/n">Next chapter</a></p>""",
    # Bare page: a column of links before and after text in divs.
    """<div><a href="/1">Gardens</a></div><div><a href="/2">Towers and walls</a></div><div><a href="/3">Opening hours</a></div>
    <div data-main>The castle has been open to visitors since the last of the family left it to the town, on condition that
    the library stay as it was and that nobody be charged for sitting in the orchard.</div>
    <div data-main>Two of the four towers can be climbed; the others are home to owls, which may be seen at dusk from the
    terrace if the weather is mild and the visitors are quiet.</div>
    <div><a href="/4">Contact us</a></div><div><a href="/5">Press</a> <a href="/6">Jobs</a></div><div>Last change: May</div>""",
    # Shop page: everything is a list of links or a form, apart from a description.
    """<div class="navbar"><a href="/">Shop</a><a href="/c">Cart</a></div><div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/l">Lamps</a></div>
    <main data-main><h1>Desk lamp, green</h1><p>A lamp with a heavy brass foot and a shade of green glass, made by hand in a
    workshop that has turned out nothing else for ninety years.</p><p>Height 40 cm.</p>
    <form data-not><select><option>one</option><option>two</option></select><button>Add to cart</button></form>
    <div class="related" data-not><h3>You may also like</h3><p>A floor lamp in the same green glass, with a longer foot and a wider shade.</p></div>
    <div class="share-buttons" data-not><a href="#">Share</a><a href="#">Pin</a></div></main>
    <div class="newsletter">Join our list and save ten percent on the first order that you place with us this year.</div>
    <div role="contentinfo">Prices include tax. Delivery within three days to most addresses on the mainland.</div>""",
    # Forum-like page with replies under the text.
    """<div role="navigation"><a href="/">Boards</a> <a href="/t">Topics</a></div><div role="main" data-main><h1>How to prune an old
    pear</h1><p>Begin with the dead wood, then take out whatever crosses, and leave the rest for the next winter: a tree that
    loses more than a third of its crown in one year answers with a thicket of water shoots.</p><p>Cut clean.</p>
    <div id="disqus_thread" data-not><p>Thanks, I did just that to ours in February, and it flowered as it had not done in the
    ten years since we moved here.</p><p>Same here.</p></div></div>
    <div class="widget"><p>Weather today: mild, with some rain towards the evening and a light wind from the west.</p></div>
    <div class="sponsored">Ladders that do not tip, tested by people who fell off all the others before.</div>
    <div class="popup">Before you go: take part in our short survey and win one of ten garden shears.</div>""",
    # Furniture of many words, and an article that holds a list of links.
    """<header class="site"><p>The Observer of the Coast, founded by the fishermen's union, read in every harbour from the
    northern cape to the border, and free of charge for all who bring their own paper to the office on the pier.</p></header>
    <aside><p>Our editors choose ten books a year which they think will still be read when the rest of the shelf has gone to
    the mill, and write about them at a length that the newspaper would never have allowed them.</p></aside>
    <article data-main><h2>Low tide</h2><p>Wet.</p><p>Cold wind all week and hardly a boat went out.</p><p>The harbour master
    counted nineteen vessels on Sunday evening, fewer than in any other March that is written down in his books, and
    went home early.</p><ul data-not><li><a href="/1">Tides</a></li><li><a href="/2">Boats</a></li><li><a href="/3">Fish</a></li>
    <li><a href="/4">Weather at sea</a></li></ul></article><section class="comments"><p>My father kept those books before him,
    and in the winter of the great frost there were eleven, as anyone can see who asks for the volume, so the record
    stands where it stood and the article ought to be corrected.</p></section>
    <footer><p>Printed and published by the union of the fishermen of the coast, who are not answerable for what readers
    write to us, nor for the tide table, which is taken from the almanac and may be wrong by a quarter of an hour.</p></footer>""",
    # Bare page with short paragraphs between long ones.
    """<table><tr><td><a href="/1">Home</a></td><td><a href="/2">Letters</a></td><td><a href="/3">Diaries</a></td></tr></table>
    <p data-main>On the fourth day the snow stopped, and we could see for the first time how far the ice had carried us: the
    mountains that had stood to the east lay behind us now, small and blue.</p><p data-main>Nobody spoke of it.</p>
    <p data-main>The dogs were fed at noon, half of what they had been given the day before, and the cook made a soup out of
    what was left of the bear and the last of the onions from the forward hold.</p><p data-main>We ate it standing.</p>
    <p data-main>Towards evening a crack opened not twenty paces from the tents; we moved everything that could be moved, and
    slept, those who slept, with our boots on and the ropes in our hands.</p>
    <p><a href="/4">Fifth day</a></p><p><a href="/5">Index of names</a> <a href="/6">Maps of the voyage and of the coast as it was known at the time</a></p>""",
    # Bare page: short lines and links only, no main text.
    """<div><a href="/1">Sign in</a></div><div>Welcome</div><div><a href="/2">Help</a></div><div>Version 2</div>
    <div><a href="/3">Terms of use and privacy</a></div><div>Page not found</div><div><a href="/4">Back to the start page</a></div>""",
    # A whole page inside a form.
    """<form action="/post"><div><a href="/">Ministry</a></div><label>Search this site</label><input type="text">
    <article data-main><h1>Notice of works</h1><p>The square will be closed from Tuesday.</p><p>Residents reach their houses
    from the south side; deliveries are possible before nine in the morning.</p></article>
    <p>By using this service you agree that the ministry may keep your answers for as long as the law demands it.</p></form>""",
    # Long paragraphs with short furniture right behind them.
    """<nav><a href="/">Home</a></nav><article data-main><h1>The clockmaker</h1><p>For eleven years the clock in the tower had
    shown twenty past four, and the town had grown so used to it that the school began and the market closed by the bells
    of the convent on the other bank, until the clockmaker came.</p><div class="advert" data-not>Watches, new and mended.</div>
    <p>She asked for a room under the bells, a lamp and a boy to hold it, and for a month nothing was heard of her but the
    sound of a file, which went on through the nights and kept the doves away.</p><div class="ad" data-not>Lamps and oil at
    fair prices.</div><p>On the first of June it struck five, at five, and half the town ran out to see what had happened,
    while the other half, who had always had their own opinion of the hour, stayed indoors and set their clocks by hers.</p>
    </article><footer>&copy; Tales of the town. Reprints on request.</footer>""",
    """<div class="menu"><a href="/1">Front</a> <a href="/2">Archive</a></div><div class="entry" data-main><p>The council met until
    midnight and voted on everything but the matter for which it had been called, namely whether the mill should be sold
    to the only man who had ever offered to buy it.</p><p>He had gone home.</p></div><div class="footer">Written by the
    night desk. Imprint.</div>""",
    """<article data-main><p>The seed should be sown thinly in April, under glass in the north and in the open where the frost
    ends early, and the rows thinned to a hand's breadth as soon as the second pair of leaves is out.</p></article>
    <div class="sidebar">Garden tools, cleaned and sharpened.</div><footer>Seeds since 1888. <a href="/o">Order</a></footer>""",
    # Bare page of long link lists around one text.
    """<p><a href="/1">The lighthouse keeper and his three daughters</a> <a href="/2">A winter among the herring fishers of the
    outer islands</a> <a href="/3">What the divers found in the wreck of the Three Brothers</a> <a href="/4">Songs that were
    sung at the capstan, with notes</a> <a href="/5">How to read a barometer when the glass is cracked</a></p>
    <p data-main>The keeper's log says nothing of the night on which the light went out. There is an entry for the day before,
    in his own hand, and one for the day after in another, and between them a line has been left blank.</p>
    <p><a href="/6">All stories by year</a> <a href="/7">All stories by the name of the ship or the harbour that they are
    about</a> <a href="/8">All stories by the weather, from dead calm to hurricane</a> <a href="/9">Stories that were sent in
    by readers and have not been checked by anybody</a></p>""",
]
