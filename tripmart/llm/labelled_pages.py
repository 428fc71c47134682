"""The labelled table of the block classifier: small pages, each with the texts of its article blocks.

Written by hand.  Every block of a page whose text is not listed is labelled as
part of the frame around the article.  The later pages have containers without
names, or lists of links inside the article, so that words and links decide.
"""

LABELLED_PAGES: list[tuple[str, frozenset[str]]] = [
    (
        """<html><head><title>River level rises</title></head><body><nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li>
        <li><a href="/w">Weather</a></li></ul></nav><div class="ad">Buy two boats and pay for one.</div>
        <article><h1>River level rises</h1><p>The river rose by two metres overnight and reached the old bridge.</p>
        <p>Quiet.</p><p>Boats were moved to the upper harbour, where <a href="/h">the harbour master</a> gave them room until Friday.</p></article>
        <footer>&copy; Valley Gazette. All rights reserved to the owners of this page.</footer></body></html>""",
        frozenset({
            "River level rises", "The river rose by two metres overnight and reached the old bridge.", "Quiet.",
            "Boats were moved to the upper harbour, where the harbour master gave them room until Friday.",
        }),
    ),
    (
        """<body><header><div>Daily Kettle</div><div>Tea, pots and people since last spring</div></header>
        <main><h1>How to boil water</h1><p>Fill the kettle to the mark.</p><ul><li>Close the lid.</li><li>Press the switch and wait.</li></ul>
        <p>Pour it.</p><blockquote>Nothing is as simple as hot water, my aunt used to say, and nothing is as easily forgotten.</blockquote></main>
        <aside><h3>Most read</h3><ul><li><a href="/1">Ten cups</a></li><li><a href="/2">One spoon</a></li></ul></aside>
        <footer><p>Imprint</p><p><a href="/p">Privacy</a></p></footer></body>""",
        frozenset({
            "How to boil water", "Fill the kettle to the mark.", "Close the lid.", "Press the switch and wait.", "Pour it.",
            "Nothing is as simple as hot water, my aunt used to say, and nothing is as easily forgotten.",
        }),
    ),
    (
        """<div class="cookie notice">We use cookies to make this page better for you and for our partners. <a href="/c">More</a></div>
        <div class="navbar"><a href="/a">Start</a> <a href="/b">Sport</a> <a href="/c">Contact</a></div>
        <div class="content"><div class="story"><h2>Goat wins race</h2><p>A goat has won the village race for the third time in a row, ahead of nine dogs.</p>
        <p>Its owner wept.</p></div><div class="sponsored">Strong hooves need strong feed, which you get at the mill.</div>
        <div class="story"><p>The mayor handed over the prize, a wreath of clover that did not last the evening.</p></div></div>
        <div class="comments"><h3>3 comments by readers of this page</h3><p>What a goat! I was there and can say that no dog had a chance on that hill.</p><p>Nonsense.</p></div>""",
        frozenset({
            "Goat wins race", "A goat has won the village race for the third time in a row, ahead of nine dogs.", "Its owner wept.",
            "The mayor handed over the prize, a wreath of clover that did not last the evening.",
        }),
    ),
    (
        """<body><div id="menu"><ul><li><a href="/x">Plants</a></li><li><a href="/y">Soil</a></li><li><a href="/z">Tools</a></li></ul></div>
        <p>Ferns like the shade, and they like it damp. In a bed on the north side of a house they grow for years without any care at all.</p>
        <p>In a dry summer one can of water a week is plenty, given in the evening, when the ground has cooled and the sun is off the leaves.</p>
        <p>Cut old fronds in spring, before the new ones unroll, and leave them on the ground, where they feed the roots in time.</p>
        <form action="/s"><label>Your address</label><input type="text"><button>Send me the newsletter</button></form>
        <div>Contact</div><div><a href="/i">Imprint and legal notice of the garden club</a></div></body>""",
        frozenset({
            "Ferns like the shade, and they like it damp. In a bed on the north side of a house they grow for years without any care at all.",
            "In a dry summer one can of water a week is plenty, given in the evening, when the ground has cooled and the sun is off the leaves.",
            "Cut old fronds in spring, before the new ones unroll, and leave them on the ground, where they feed the roots in time.",
        }),
    ),
    (
        """<body><article><header><h1>Night train back</h1></header><p>After nine years the night train to the coast runs again, three times a week.</p>
        <aside class="related">See also: <a href="/t">All trains of the summer timetable at a glance</a></aside>
        <p>Berths are sold from Monday on.</p><div class="share"><a href="/f">Share</a> <a href="/m">Mail</a></div>
        <h2>Old cars, new paint</h2><p>The cars are from the eighties, but <b>windows</b>, beds and lamps are new.</p>
        <section class="comments"><p>I took it in my youth and never slept so well as to the sound of those wheels.</p><p>Me too!</p></section>
        <div class="newsletter"><p>Sign up and get the best of our travel pages every week.</p><form><button>Sign up</button></form></div></article>
        <footer><ul><li>Terms</li><li>Jobs</li></ul></footer></body>""",
        frozenset({
            "Night train back", "After nine years the night train to the coast runs again, three times a week.", "Berths are sold from Monday on.",
            "Old cars, new paint", "The cars are from the eighties, but windows, beds and lamps are new.",
        }),
    ),
    (
        """<body><div class="masthead">The Lantern</div><div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/k">Kitchen</a></div>
        <div id="main"><h1>Bread</h1><p>Flour.</p><p>Water.</p><p>Salt, and a night of patience.</p><table><tr><td>Oven</td><td>230 degrees</td></tr></table>
        <p>Knead it for ten minutes, let it rest, fold it, let it rest again, and bake it until it sounds hollow.</p></div>
        <div class="sidebar"><p>Our baker answers your questions every Tuesday from nine to eleven in the shop at the market.</p>
        <ul><li><a href="/r">Rolls</a></li><li>Open daily</li></ul></div><div class="footer">Printed on paper. Read on screens.</div></body>""",
        frozenset({
            "Bread", "Flour.", "Water.", "Salt, and a night of patience.", "Oven", "230 degrees",
            "Knead it for ten minutes, let it rest, fold it, let it rest again, and bake it until it sounds hollow.",
        }),
    ),
    (
        """<body><ul><li><a href="/1">One</a></li><li><a href="/2">Two</a></li><li><a href="/3">Three</a></li></ul>
        <div><p>The museum reopens on Sunday. Its new wing shows clocks from four centuries, most of which still run and strike the hours.</p>
        <p>Visitors may wind two of them on the first day, under the eyes of the restorer who spent six years on their springs and wheels.</p></div>
        <div><a href="/p">Previous page</a> <a href="/q">Next page</a></div><div>Tickets</div><div>Call us</div></body>""",
        frozenset({
            "The museum reopens on Sunday. Its new wing shows clocks from four centuries, most of which still run and strike the hours.",
            "Visitors may wind two of them on the first day, under the eyes of the restorer who spent six years on their springs and wheels.",
        }),
    ),
    (
        """<body><nav><a href="/a">All</a><a href="/b">Local</a></nav><div class="advert"><p>A roof over your head, built in a day, paid in a year, and loved for a lifetime.</p></div>
        <article><h1>Ice</h1><p>Ice.</p><p>The lake froze. <a href="/l">Lake</a></p><p><a href="/photo">Pictures of the frozen lake</a></p><ol><li>First</li><li>Second</li></ol></article>
        <div class="promo">Skates, half price, this week only.</div><footer><p>All pictures and words on this site belong to those who made them, and to nobody else.</p></footer></body>""",
        frozenset({"Ice", "Ice.", "The lake froze. Lake", "Pictures of the frozen lake", "First", "Second"}),
    ),
    (
        """<body><header><p>The Hill Post has brought news from both sides of the ridge since the days of the mail coach, and it still arrives before breakfast in every village.</p></header>
        <nav><p><a href="/1">All the stories of this week in one long list, from the first to the last, with pictures and with a map of where they happened</a></p></nav>
        <div class="ad">Our beds are built by hand from the oak of these hills, and whoever has slept in one for a single night has never gone back to any other kind of bed.</div>
        <article><h1>A wall comes down</h1><p>The old wall behind the school fell in the storm, and nobody was near it when it did, which the teachers call a wonder.</p>
        <p>Stones lie there.</p><p>Until it is built again, which may take until autumn, classes will have their breaks in the yard of the fire brigade, next to the engine.</p></article>
        <div class="comments"><p>I said it years ago at the council, and all of them laughed at me: a wall without a drain will fall as soon as there is enough rain behind it.</p>
        <p>My grandfather built that wall with his own hands in the winter after the flood, and I would like to have one of its stones for my garden.</p></div>
        <aside><h3>What you will read in our next issue</h3><p>In the next issue you will read how the bees of the upper valley came through the winter, and why their keeper now sells candles instead of honey.</p></aside>
        <form><h4>Tell us what you think of it</h4><p>Write to us what you think about this story, with your name and the village you live in, and we will print the best letters on the last page.</p></form>
        <footer><h4>Who owns the words on this page</h4><p>No part of this page may be copied, stored or read aloud for money without the written leave of its publisher, who is easy to find and hard to convince.</p></footer></body>""",
        frozenset({
            "A wall comes down", "The old wall behind the school fell in the storm, and nobody was near it when it did, which the teachers call a wonder.",
            "Stones lie there.",
            "Until it is built again, which may take until autumn, classes will have their breaks in the yard of the fire brigade, next to the engine.",
        }),
    ),
    (
        """<body><div class="cookie-banner"><p>This site keeps small files on your machine, so that it knows you when you come back, counts its readers and shows you what others pay it to show you.</p></div>
        <div><a href="/a">Front page</a> <a href="/b">Letters</a> <a href="/c">Weather for the week on the hills and in the plain</a> <a href="/d">What is on in the halls of the county this month</a> <a href="/e">Work</a> <a href="/f">Rooms to let</a></div>
        <div class="post"><h2>Owls</h2><p>Two owls nest in the tower of the town hall, which is why its clock has not struck at night since March and will not until they leave.</p>
        <p>They do not mind the bells of the church.</p></div>
        <div class="sidebar"><h3>A walk by night, and with us</h3><p>Whoever would like to walk with our reporter through the woods at night, with a lamp but without a word, may meet us at the mill on Friday at ten.</p></div>
        <div class="notice"><p>The office of this paper stays closed on Monday, since all of us will be at the fair, where you are welcome to tell us your stories in person and at length.</p></div>
        <div class="footer"><p>Set in the types of our founder, printed by wind and water, and brought to your door by the post, which has been late only once in a hundred and ten years.</p></div></body>""",
        frozenset({
            "Owls", "Two owls nest in the tower of the town hall, which is why its clock has not struck at night since March and will not until they leave.",
            "They do not mind the bells of the church.",
        }),
    ),
    (
        """<body><article><header><h1>Long way home</h1></header><p>She walked from the coast to her village in forty days, with a dog, two shirts and a letter that she had promised to bring.</p>
        <div class="ad">Shoes that do not wear out on the first hundred miles, nor on the next, made for all who go further than they had meant to go.</div><p>The letter was for her.</p></article>
        <article><header><h2>Short way out</h2></header><p>He took the window.</p></article><div>Older</div><div>Newer</div></body>""",
        frozenset({
            "Long way home", "She walked from the coast to her village in forty days, with a dog, two shirts and a letter that she had promised to bring.",
            "The letter was for her.", "Short way out", "He took the window.",
        }),
    ),
    (
        """<body><div><a href="/a">Front</a> <a href="/b">Town</a> <a href="/c">County</a></div><div>The finest coats at Miller's.</div>
        <h1>Tram leaves the rails</h1><div><p>A tram left the rails at the market on Tuesday morning, shortly before the first school bell.</p><p>Nobody was hurt.</p>
        <p>Two cars were lifted back by a crane, as <a href="/v">a film by passers-by</a> shows, and by noon the line was open again.</p><p>The cause is not known.</p>
        <p>"It was a stone," says the driver.</p></div>
        <div><a href="/1">Older trams</a></div><div><a href="/2">A map of all the lines in town</a></div><div>The Town Post, 4 Mill Lane.</div></body>""",
        frozenset({
            "Tram leaves the rails", "A tram left the rails at the market on Tuesday morning, shortly before the first school bell.", "Nobody was hurt.",
            "Two cars were lifted back by a crane, as a film by passers-by shows, and by noon the line was open again.", "The cause is not known.",
            "\"It was a stone,\" says the driver.",
        }),
    ),
    (
        """<body><nav><a href="/">Start</a></nav><article><h1>What the lake gives</h1><p>Five kinds of fish live in the lake.</p><p>Two of them are caught.</p>
        <h3>More on this</h3><ul><li><a href="/1">A day on the boat</a></li><li><a href="/2">The price of perch since the war</a></li><li><a href="/3">Nets</a></li>
        <li><a href="/4">How to clean a fish</a></li><li><a href="/5">Smoke and salt</a></li></ul></article><footer>Lake Paper</footer></body>""",
        frozenset({"What the lake gives", "Five kinds of fish live in the lake.", "Two of them are caught."}),
    ),
    (
        """<body><main><ul><li><a href="#1">Tools</a></li><li><a href="#2">Clay</a></li><li><a href="#3">Fire</a></li><li><a href="#4">Glaze</a></li></ul>
        <h1>A pot in four steps</h1><ol><li>Wedge the clay.</li><li>Throw it on <a href="/w">the wheel</a>.</li><li>Dry it for a week, out of the wind.</li><li>Fire it twice.</li></ol>
        <p>Then fill it.</p></main><div><a href="/x">Imprint</a> <a href="/y">Shop</a></div></body>""",
        frozenset({
            "A pot in four steps", "Wedge the clay.", "Throw it on the wheel.", "Dry it for a week, out of the wind.", "Fire it twice.", "Then fill it.",
        }),
    ),
    (
        """<body><table><tr><td><a href="/n">New</a></td><td><a href="/o">Old</a></td><td><a href="/p">People</a></td></tr></table><div>Win a goose.</div>
        <h1>The last lamp</h1><p>On Friday the last gas lamp of the town went out.</p><p>It had burned for ninety years.</p><h2>Who lit it</h2>
        <p>For the last thirty of them it was lit by one man, who came every evening with a ladder and a match, and who never missed a day.</p><p>He is eighty.</p>
        <p>Some came to see it.</p><p>The town will keep the lamp in <a href="/m">its museum</a>.</p><div>All rights with the owner of this page.</div></body>""",
        frozenset({
            "The last lamp", "On Friday the last gas lamp of the town went out.", "It had burned for ninety years.", "Who lit it",
            "For the last thirty of them it was lit by one man, who came every evening with a ladder and a match, and who never missed a day.", "He is eighty.",
            "Some came to see it.", "The town will keep the lamp in its museum.",
        }),
    ),
    (
        """<body><div><a href="/h">Home</a></div><div><a href="/s">Songs</a></div><div>Strings at half price until Sunday.</div><h2>A fiddle from a box</h2><p>He had no money.</p>
        <p>So he took a box for cigars, the neck of a broken guitar and four wires from a fence, and played them until the neighbours came.</p>
        <ul><li>One wire broke.</li><li>Three were enough.</li></ul><p>They danced.</p><p>It hangs in the bar to this day, and on feast days someone takes it down.</p>
        <h4>Read on</h4><div><a href="/1">A drum from a bin</a></div><div><a href="/2">A flute from a pipe, in ten minutes and with one tool</a></div>
        <div>Folk and Wood, a paper for players</div></body>""",
        frozenset({
            "A fiddle from a box", "He had no money.",
            "So he took a box for cigars, the neck of a broken guitar and four wires from a fence, and played them until the neighbours came.",
            "One wire broke.", "Three were enough.", "They danced.", "It hangs in the bar to this day, and on feast days someone takes it down.",
        }),
    ),
    (
        """<body><article><h1>Snow in May</h1><p>It snowed on the second of May.</p><p><a href="/f">A film of it</a></p><p>The old people had seen it before, in the year of the comet.</p>
        <ul><li><a href="/1">Snow in June</a></li><li><a href="/2">Hail</a></li><li><a href="/3">The year without a summer</a></li></ul>
        <p>By noon it was gone.</p></article><div><a href="/q">Up</a></div><div>Hill Weather</div></body>""",
        frozenset({
            "Snow in May", "It snowed on the second of May.", "A film of it", "The old people had seen it before, in the year of the comet.", "By noon it was gone.",
        }),
    ),
    (
        """<body><div><a href="/a">Papers</a> <a href="/b">Books</a></div><div>Buy two, read three.</div><h1>The reader</h1><p>She reads on the roof.</p><p>There, she says, no door bell is heard, and the gulls
        don't ask what it is about.</p><p>Two books a day.</p><p>In winter she sits by the chimney, which is warm, and wears her father's coat and his hat.</p><div>Set in Leeds.</div></body>""",
        frozenset({
            "The reader", "She reads on the roof.", "There, she says, no door bell is heard, and the gulls don't ask what it is about.", "Two books a day.",
            "In winter she sits by the chimney, which is warm, and wears her father's coat and his hat.",
        }),
    ),
    (
        """<body><article><h1>Notes on moss</h1><p>Moss drinks through its leaves, as <a href="/k">Karlsen</a>, <a href="/o">Otto</a> and <a href="/p">the old Prior</a> have shown.</p>
        <p>See <a href="/1">the first plate</a> and <a href="/2">the second plate</a>.</p><p>It grows on stone.</p><h4>See also</h4><ul><li><a href="/f">Ferns</a></li><li><a href="/l">Lichens and where to look for them</a></li><li><a href="/a">Algae</a></li></ul></article>
        <div>Garden Leaves</div></body>""",
        frozenset({
            "Notes on moss", "Moss drinks through its leaves, as Karlsen, Otto and the old Prior have shown.", "See the first plate and the second plate.", "It grows on stone.",
        }),
    ),
    (
        """<body><ul><li><a href="/a">Ships</a></li><li><a href="/b">Ports</a></li><li><a href="/c">Crews</a></li></ul><div>Ropes of hemp, of steel and of silk, for ships of every size, on the quay.</div>
        <h1>A ship without a captain</h1><p>She came in with the tide.</p><p>No one was on board when the pilot climbed up, the stove was warm, and a cat slept on the charts.</p><p>The cat is well.</p>
        <div>Harbour Sheet, printed at the old lock.</div></body>""",
        frozenset({
            "A ship without a captain", "She came in with the tide.",
            "No one was on board when the pilot climbed up, the stove was warm, and a cat slept on the charts.", "The cat is well.",
        }),
    ),
    (
        """<body><nav><a href="/a">Rooms</a> <a href="/b">Board</a></nav><article><h1>The inn on the pass</h1><p>It has four beds.</p><p>Soup is at six.</p></article></body>""",
        frozenset({"The inn on the pass", "It has four beds.", "Soup is at six."}),
    ),
    ("<main><p>Closed today.</p></main>", frozenset({"Closed today."})),
    (
        """<div class="menu"><a href="/a">Up</a></div><article><p>The bell rang twice.</p><p>Then all was still, and the snow went on falling on the square, the carts and the sleeping geese.</p><p>Good night.</p></article>""",
        frozenset({"The bell rang twice.", "Then all was still, and the snow went on falling on the square, the carts and the sleeping geese.", "Good night."}),
    ),
    (
        """<article><h1>Rain</h1><p>Rain.</p><p>It rained.</p></article><article><h2>Sun</h2><p>It did not last.</p><ul><li>One hour</li><li>Two rainbows</li></ul></article>""",
        frozenset({"Rain", "Rain.", "It rained.", "Sun", "It did not last.", "One hour", "Two rainbows"}),
    ),
    (
        """<body><article><h1>Toll</h1><p>The bridge costs a penny.</p><p>It is dear.</p></article><ul><li><a href="/1">Ferry</a></li><li><a href="/2">Ford</a></li><li><a href="/3">Boats for hire on the river</a></li></ul></body>""",
        frozenset({"Toll", "The bridge costs a penny.", "It is dear."}),
    ),
    (
        """<body><article><h1>Oats</h1><p>Oats grow.</p><p>They are cut.</p><ul><li><a href="/1">Rye</a></li><li><a href="/2">Wheat</a></li></ul><p>Then threshed.</p>
        <p>And eaten.</p></article><div><a href="/1">Barley</a></div><div><a href="/2">Mills</a></div></body>""",
        frozenset({"Oats", "Oats grow.", "They are cut.", "Then threshed.", "And eaten."}),
    ),
    (
        """<body><article><p>The letter lay in a drawer of the town hall for two hundred years before a clerk found it behind the seals.</p><p><a href="/l">The letter itself.</a></p>
        <p>It asks the council for a cow, for the widow of a soldier, and gives three reasons, all of which are good.</p><p><a href="/r">What the council replied</a></p>
        <p>She got two cows, and one of them, as the books of the year show, won a prize at the autumn fair.</p></article><div>Town Hall News</div></body>""",
        frozenset({
            "The letter lay in a drawer of the town hall for two hundred years before a clerk found it behind the seals.", "The letter itself.",
            "It asks the council for a cow, for the widow of a soldier, and gives three reasons, all of which are good.", "What the council replied",
            "She got two cows, and one of them, as the books of the year show, won a prize at the autumn fair.",
        }),
    ),
    (
        """<body><div><a href="/a">Maps</a></div><div><a href="/b">Trails</a></div><div>Boots that last.</div><h1>Over the ridge</h1><p>You need a day, a map and good shoes, and you should tell someone where you mean to go before you leave the last house.</p>
        <p>Start.</p><p>From the church the path climbs through beeches for an hour, then through pines, and at the well it turns to the left.</p><p>Rest.</p><p>Drink.</p>
        <p>The ridge itself is bare, and on a clear day you see both seas from it, the towers of the city and the smoke of the works.</p><p>Down.</p>
        <p>Buses leave at five.</p><div>Walkers' Weekly, every Friday at the kiosk.</div></body>""",
        frozenset({
            "Over the ridge", "You need a day, a map and good shoes, and you should tell someone where you mean to go before you leave the last house.", "Start.",
            "From the church the path climbs through beeches for an hour, then through pines, and at the well it turns to the left.", "Rest.", "Drink.",
            "The ridge itself is bare, and on a clear day you see both seas from it, the towers of the city and the smoke of the works.", "Down.",
            "Buses leave at five.",
        }),
    ),
    (
        """<body><div><a href="/a">Poems</a> <a href="/b">Plays</a></div><h1>The prompter</h1><p>For forty years he sat in a box below the stage, and no one but the actors ever saw his face.</p><p>He knew it all.</p>
        <p>On his last night the whole house stood up and said the final line for him, and he, for once, had nothing to say.</p></body>""",
        frozenset({
            "The prompter", "For forty years he sat in a box below the stage, and no one but the actors ever saw his face.", "He knew it all.",
            "On his last night the whole house stood up and said the final line for him, and he, for once, had nothing to say.",
        }),
    ),
    (
        """<body><div><a href="/a">Bees</a></div><div><a href="/b">Birds</a></div><div>Seeds by post.</div><h1>Swifts are back</h1><p>They came on the first of May.</p><p>Hundreds of them hunt above the roofs.</p>
        <p>Their nests are under the tiles.</p><div>The county society for birds thanks all who count with us every spring.</div></body>""",
        frozenset({"Swifts are back", "They came on the first of May.", "Hundreds of them hunt above the roofs.", "Their nests are under the tiles."}),
    ),
    (
        """<body><div><a href="/a">Wine</a> <a href="/b">Beer</a></div><div>Corks, caps and labels from the works in the valley.</div><h1>A dry year</h1><p>It has not rained since March, and the vines stand grey on the southern slopes above the river.</p>
        <p>Little will be picked.</p><p>What there is will be sweet, says the vintner.</p><div>Vine and Barrel, a paper from the hills, is printed in the old press house.</div></body>""",
        frozenset({
            "A dry year", "It has not rained since March, and the vines stand grey on the southern slopes above the river.", "Little will be picked.",
            "What there is will be sweet, says the vintner.",
        }),
    ),
    (
        """<body><div><a href="/a">Sea</a></div><div><a href="/b">Land</a></div><div>Nets mended.</div><h2>The buoy</h2><p>A buoy broke loose in the storm.</p><p>It drifted south.</p><p>On Sunday a girl found it.</p>
        <div>Coast Letters, with the tides of the week, for all between the capes.</div></body>""",
        frozenset({"The buoy", "A buoy broke loose in the storm.", "It drifted south.", "On Sunday a girl found it."}),
    ),
    (
        """<body><article><h1>The choir</h1><p>The choir of the mill sang in the hall on Saturday, and the hall was full to the last stair.</p><p><a href="/c">The programme</a></p><p>They sang for two hours.</p>
        <p>At the end the oldest of them, who is ninety, sang a song of his own about the wheel and the water.</p><p><a href="/s">Hear the song</a></p><p>It is short.</p></article></body>""",
        frozenset({
            "The choir", "The choir of the mill sang in the hall on Saturday, and the hall was full to the last stair.", "The programme", "They sang for two hours.",
            "At the end the oldest of them, who is ninety, sang a song of his own about the wheel and the water.", "Hear the song", "It is short.",
        }),
    ),
    (
        """<body><nav><a href="/a">Stage</a> <a href="/b">Screen</a></nav><article><h1>Masks</h1><p>The masks are carved from lime.</p><p><a href="/m">All the masks</a></p><p>They are worn once a year, by the youngest.</p>
        <p><a href="/d">The dance, in a film from the archive</a></p><p>Then they are burned.</p><p><a href="/f">The fire</a></p><p>The ashes are kept in a jar on the altar until the next carver is chosen.</p></article>
        <div><a href="/i">Imprint</a></div></body>""",
        frozenset({
            "Masks", "The masks are carved from lime.", "All the masks", "They are worn once a year, by the youngest.", "The dance, in a film from the archive",
            "Then they are burned.", "The fire", "The ashes are kept in a jar on the altar until the next carver is chosen.",
        }),
    ),
]
