"""Pages labelled by hand, of markup unlike the generator's: [[ ]] stand around each of the article's blocks."""

PAGES = [
    "<html><head><title>Bread</title></head><body><div class=top><a href=/>Home</a> <a href=/r>Recipes</a></div><div class=c2><h2>[[Rye bread in a day]]</h2><p>[[Mix the flour and the water in the morning, and let them stand.]]<p>[[Bake in the evening for an hour.]]<ol><li>[[Weigh the flour before anything else.]]</ol></div><div class=btm>Copyright 2021 The Baker. All rights reserved.</div>",
    "<body><table width=100%><tr><td colspan=2><font size=5>Old Village Site</font></td></tr><tr><td width=120><a href=a>News</a><br><a href=b>Map</a></td><td><article><h1>[[The mill]]</h1><p>[[The mill was built in 1702 by two brothers from the valley.]]</p><p>[[It burnt down twice, and was rebuilt each time with more stone.]]</p></article></td></tr></table>",
    "<html><body><nav><a href=1>One</a><a href=2>Two</a></nav><main><h1>[[Terms of the trade]]</h1><dl><dt>[[Warp]]<dd>[[The threads that run along the length of the cloth.]]<dt>[[Weft]]<dd>[[The thread that is carried across by the shuttle.]]</dl></main><footer>Contact us - Imprint</footer></body></html>",
    "<html><body><header><div>Dev Notes</div></header><main class=page><h1>[[Reading a file line by line]]</h1><p>[[Open the file and walk over it; the runtime reads ahead for you.]]</p><pre>[[with open(name) as f: print(sum(1 for line in f))]]</pre><p>[[Nothing else is needed for files of any size.]]</p></main><aside><h3>Popular</h3><ul><li><a href=x>Ten tricks</a><li><a href=y>More tricks</a></ul></aside></body></html>",
    "<body><div id=hd><ul><li><a href=/>Start</a><li><a href=/k>Kontakt</a></ul></div><div id=mn><article><h1>[[Der Fluss im Winter]]</h1><p>[[Im Januar friert der Fluss an den Ufern zu, und die Boote liegen still.]]</p><blockquote>[[Wer dann hinausgeht, hört das Eis singen.]]</blockquote><p>[[Erst im März bricht es auf.]]</p></article></div><div id=ft>Impressum | Datenschutz</div>",
    "<body><div class=cookie-bar>We use cookies. <button>Accept</button></div><main><article><h1>[[A walk along the dyke]]</h1><p>[[The path begins behind the church and follows the water for two miles.]]</p><figure><img src=d.jpg><figcaption>[[The dyke at low tide, seen from the north.]]</figcaption></figure><p>[[Bring boots, for the last part is mud.]]</p></article></main>",
    "<body><article><header><h1>[[How bees find home]]</h1></header><section><h2>[[Landmarks]]</h2><p>[[A bee remembers the trees and walls around its hive.]]</p></section><section><h2>[[The sun]]</h2><p>[[On clear days it steers by the sun, and by the pattern of the sky when the sun is hidden.]]</p></section></article><section class=comments><h3>2 comments</h3><p>Great post!</p><p>I disagree with all of it.</p></section>",
    "<body><nav class=menu><ul><li><a href=/>Accueil</a><li><a href=/m>Mentions légales</a></ul></nav><main><h1>[[Le pain de seigle]]</h1><p>[[On pétrit la farine avec de l'eau tiède et un peu de sel.]]</p><p>[[Après une nuit de repos, la pâte a doublé de volume.]]</p></main><footer><p>&copy; 2020 La Boulangerie</p></footer>",
    "<body><div class=wrap><div class=l><h4>Menu</h4><a href=1>Shop</a></div><div class=r><article><h1>[[Winter tyres]]</h1><table><tr><th>[[Size]]<th>[[Weight in kg]]<tr><td>[[195/65]]<td>[[9.1]]</table><p>[[Heavier tyres wear the bearings sooner than light ones.]]</p></article></div></div>",
    "<body><div role=banner>The Daily Paper</div><div role=main><h1>[[Bridge to close for repairs]]</h1><p>[[The bridge over the northern canal closes on Monday for six weeks.]]</p><p>[[Ferries will run every ten minutes from early morning on.]]</p></div><div role=contentinfo>About - Privacy</div>",
    "<body><form action=/s><input name=q><button>Search</button></form><article><h1>[[Keeping cheese]]</h1><p>[[Cheese keeps best in paper, not in plastic.]]</p><ul><li>[[Hard cheese likes the cellar.]]</ul><p>[[Wrap it anew each time it is cut.]]</p></article>",
    "<body><main><article><h1>[[The night train]]</h1><p data-note=don't>[[It leaves at ten and crosses the border before dawn.]]</p><p>[[It's slow, but the beds are good.]]</p></article><aside class=related><h3>Related</h3><a href=1>Day trains</a></aside></main>",
    "<body><div class=ad>Buy two, get one free!</div><article><p>[[No heading stands above this note, which is only a paragraph long but says what it has to.]]</p></article><div class=ad>Sale ends soon</div>",
    "<body><header class=masthead><h1>Weather Blog</h1><p>All about clouds</p></header><article class=hentry><h2>[[Why fog lifts]]</h2><p>[[The sun warms the ground, the ground warms the air, and the drops evaporate from below.]]</p></article><nav class=pager><a href=p>Older posts</a></nav>",
    "<body><article><h1>[[Learning to swim at sixty]]</h1><div class=byline-x></div><p>[[I had always been afraid of deep water.]]</p><div class=ad>Swimwear 20% off</div><p>[[The teacher told me to breathe out, and that was all.]]</p></article>",
    "<body><noscript>Please enable JavaScript</noscript><main><h1>[[On tuning pianos]]</h1><p>[[A piano is tuned from the middle outwards, octave by octave.]]</p><p>[[The ear hears the beats between two strings.]]</p></main><script>track('</p>')</script>",
    "<body><article><h1>[[La huerta en otoño]]</h1><p>[[En octubre se siembran los ajos y las habas.]]</p><h2>[[El riego]]</h2><p>[[Basta con la lluvia si el suelo está cubierto de paja.]]</p></article><div class=share><a href=f>Compartir</a></div>",
    "<body><ul class=breadcrumb><li><a href=/>Home</a><li><a href=/g>Garden</a></ul><article><h1>[[Pruning roses]]</h1><p>[[Cut above an outward bud, at a slant.]]</p><ol><li>[[Remove dead wood.]]<li>[[Shorten the rest by a third.]]</ol></article>",
    "<body><main><article><h1>[[Letters from the front]]</h1><blockquote><p>[[Dear mother, we have moved again and the roads are bad.]]</p></blockquote><p>[[He wrote every week until the winter.]]</p></article></main><div class=newsletter><p>Subscribe to our newsletter</p><input><button>Sign up</button></div>",
    "<body><div class=site><div class=head><a href=/>Logo</a></div><div class=entry-content><p>[[The old road is still there, under the grass.]]</p><p>[[You can follow it by the stones at its sides, which were set every hundred paces.]]</p></div><div class=sidebar><h3>Archive</h3><ul><li><a href=1>May</a><li><a href=2>June</a></ul></div></div>",
    "<body><article><h1>[[Salt]]</h1><p>[[Salt is won from the sea, from springs and from mines.]]</p><hr><p>[[The mines are the oldest.]]</p></article><footer><ul><li><a href=1>Privacy</a><li><a href=2>Terms</a></ul></footer>",
    "<body><div class=modal>Log in to continue <button>Close</button></div><main><h1>[[Three ways to tie a boat]]</h1><h2>[[The bowline]]</h2><p>[[It holds under load and comes loose when you want it to.]]</p><h2>[[The cleat hitch]]</h2><p>[[One turn, one eight, one lock.]]</p></main>",
    "<body><nav>Home | About</nav><article><h1>[[What the owl eats]]</h1><p>[[Mice, mostly; in wet years also frogs.]]<p>[[The bones are found in pellets below the nest.]]<p>[[A pair with young takes a dozen mice in a night.]]</article><footer>Written by volunteers</footer>",
    "<body><main><article><h1>[[The price of wool]]</h1><p>[[Prices fell for the third year.]]</p><p>[[Farmers shear all the same, for the sake of the sheep.]]</p></article></main><section class=related-posts><h2>Read next</h2><ul><li><a href=a>The price of milk</a><li><a href=b>The price of hay</a></ul></section>",
    "<body><div class=banner>Winter sale</div><div class=content><h1>[[Skating on natural ice]]</h1><p>[[Black ice is safe from five centimetres on.]]</p><p>[[White ice is half as strong.]]</p></div><div class=footer>Opening hours: 9-5</div>",
    "<body><article><h1>[[Glass]]</h1><details><summary>[[How it is made]]</summary><p>[[Sand, soda and lime are melted together at a high heat.]]</p></details><p>[[Blown glass is still made in a few places.]]</p></article><div id=disqus><p>Nice.</p></div>",
    "<body><header><nav><a href=1>World</a><a href=2>Sport</a></nav></header><main><article><h1>[[Goalkeeper retires]]</h1><p>[[After twenty seasons she leaves the club that she joined as a child.]]</p><p>[[Her last match is on Sunday.]]</p></article></main><aside class=sponsored><p>Cheap flights from 19 euros</p></aside>",
    "<body><div class=x><div class=y><article><h1>[[Ants and aphids]]</h1><div><p>[[Ants milk aphids for their honeydew.]]</p><p>[[In return they keep the beetles away.]]</p></div></article></div></div><div class=tags><a href=t>ants</a></div>",
    "<body><div class=notice>This page was moved.</div><article><h1>[[Cooking rice]]</h1><p>[[One cup of rice, two cups of water.]]</p><p>[[Do not lift the lid.]]</p></article><div class=social><a href=f>Share</a><a href=t>Tweet</a></div>",
    "<body><main><h1>[[Minutes of the meeting]]</h1><ul><li>[[The roof is to be mended before the autumn.]]<li>[[The choir asks for new chairs.]]<li>[[The next meeting is in May.]]</ul></main><footer>Parish office</footer>",
    "<body><article><h1>[[The lighthouse keeper]]</h1><p>[[He lit the lamp at dusk &amp; slept by day.]]</p><p>[[In storms he didn&#39;t sleep at all.]]</p></article><form class=contact><label>Your name</label><input><label>Message</label><textarea></textarea></form>",
    "<body><div class=topbar><a href=1>Sign in</a></div><div class=story><h1>[[Flood reaches the old town]]</h1><p>[[The river rose two metres in a night.]]</p><p>[[Sandbags were laid along the quay by hundreds of people.]]</p><p>[[No one was hurt.]]</p></div><div class=promo>Subscribe now for one euro</div>",
    "<body><article><h1>[[Dry stone walls]]</h1><p>[[No mortar holds them, only weight.]]</p><section class=responses><p>My grandfather built these.</p><p>Mine too.</p></section></article><footer>&copy; Stone society</footer>",
    "<body><main><article><h1>[[A short history of ink]]</h1><p>[[Soot and gum made the first inks.]]</p><p>[[Iron gall ink came later and ate the paper.]]</p><p>[[Printers needed oil.]]</p></article></main><nav class=pagination><a href=1>Previous</a><a href=3>Next</a></nav>",
    "<body><div class=main-text><h1>[[Sourdough, again]]</h1><p>[[My starter died in the heat.]]</p><p>[[I began a new one from the flour that was left.]]</p></div><ul class=meta-links><li><a href=1>Permalink</a></ul>",
    "<body><header>My travels</header><article><h1>[[Two days in the hills]]</h1><h3>[[Day one]]</h3><p>[[We climbed until noon and ate by the spring.]]</p><h3>[[Day two]]</h3><p>[[It rained, so we read.]]</p></article><aside><p>About me: I walk.</p></aside>",
    "<body><main><article><h1>[[The clock in the tower]]</h1><p>[[It strikes the hours late, as it always has.]]</p><table><tr><td>[[Built]]<td>[[1612]]<tr><td>[[Repaired]]<td>[[1848]]</table></article></main><div class=login><p>Forgot your password?</p></div>",
    "<body><nav><ul><li><a href=1>Blog</a></ul></nav><article><h1>[[Notes on silence]]</h1><p>[[Libraries are not silent; they hum.]]</p></article><div class=comment-list><div class=comment><p>So true.</p></div></div>",
    "<body><div class=legal>Terms apply.</div><article><h1>[[Growing hops]]</h1><p>[[Hops climb six metres in a summer.]]</p><p>[[They are picked in September.]]</p><ul><li>[[Pick them dry.]]<li>[[Dry them in the dark.]]</ul></article>",
    "<body><main><section><h1>[[Repairing a chair]]</h1><p>[[Take the joints apart before you glue them.]]</p><p>[[Clamp for a day.]]</p></section></main><footer><p>Contact: Workshop, 3 Mill Lane</p></footer>",
]
