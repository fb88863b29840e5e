"""A small labelled URL table: whole addresses, invented, on reserved domains and documentation addresses."""

#: To block: gambling, pills, dating, loans, fakes, cracked programs, link farms, trackers.
UNWANTED = """
https://www.royal-casino-online.example/slots?ref=7781
http://casino-win.example.net/en/44
https://bet365plus.casino-lounge.test/bonus/free-spins.html
http://lucky-jackpot.example/play-now?aff=221&sub=9
https://slots-city.test/mobile/download-app
http://m.poker-stars-room.example:8080/tables/holdem?id=3
https://livebets.example/football/odds-today
https://sportsbet-tips.test/vip/sure-win-odds.php?day=12
http://192.0.2.14/casino/index.php?promo=WELCOME100
https://roulette.big-win-club.example/no-deposit-bonus
https://betting-offers.example.org/de/8812#signup
http://online-bingo-bonus.test/claim/free-100
http://cheap-pills-direct.example/buy/viagra-no-prescription
https://rx-meds-online.test/order?item=cialis&qty=90
http://pharmacy-discount.example/buy-cheap-tramadol.html
https://weight-loss-pills.example.net/es/91?utm_source=spam
http://canadian-meds.test/cheap/generic/xanax-2mg
https://keto-gummies-miracle.example/lose-weight-fast/
http://198.51.100.7:81/pills/order.php?sid=99127
https://testosterone-boost.example/free-trial-offer?cid=5
https://best-steroids-shop.test/buy/anabolic-cheap
http://enlarge-now.example/secret-formula.php
https://hot-singles-tonight.example/meet/near-you
http://adult-cams-live.test/girls/free-chat
https://xxx-tube-videos.example/watch/hd/88123.html
http://sexy-cams.example.org/en/778
https://dating-adult.test/join-free?click_id=ab91
http://naughty-chat-rooms.example/18plus/enter
https://www.escort-directory.test/city/listing?page=4
http://porn-pics-gallery.example/gallery/9912/
https://webcam-strip.example.com/fr/19
http://203.0.113.90/xxx/free-videos.htm
https://payday-loans-fast.example/apply-now?amount=1000
http://bad-credit-loan.test/instant-approval.html
https://quick-cash-advance.example/no-credit-check
http://debt-relief-offer.example.net/de/63?gclid=zz1
https://forex-profit-signals.test/join/vip-group
http://crypto-doubler.example/send-1-get-2.php
https://bitcoin-giveaway.example/claim?wallet=free
http://earn-money-home.test/5000-per-week/start
https://make-money-fast.example.org/en/2
http://binary-options-robot.example/autotrade/signup
https://replica-watches-shop.example/rolex-fake-cheap
http://cheap-designer-bags.test/sale/90-off?sku=114
https://fake-sneakers-outlet.example/buy-now/air
http://luxury-replica.example.com/es/700
https://discount-handbags.test/outlet/cheap/louis?off=85
http://free-ringtones-download.example/top100/mp3
https://warez-full-crack.example/windows-keygen.zip
http://keygen-serial.test/download/crack/photoshop.rar
https://torrent-movies-free.example/hd-download/2023
http://cracked-apk-mods.test/unlimited-coins-hack
https://free-robux-generator.example/human-verification
http://game-cheats-hack.example.net/fr/51?dl=1
https://download-full-version.test/setup.exe?src=ads
http://driver-updater-free.example/download-now.exe
https://pc-virus-alert.test/scan/your-computer-is-infected
http://192.0.2.200/update/flash_player_install.exe
https://spam-farm.example.org/en/728?utm_source=feed
http://link-farm.example.net/en/9
https://buy-backlinks-cheap.example/seo/10000-links
http://seo-traffic-bot.test/buy-traffic/adsense
https://instant-followers.example/instagram/buy-likes
http://ads.click-tracker.example/r?u=aHR0&cid=771&pub=3
https://track.ad-server.test/imp?zone=12&rnd=88172
http://pop-ads.example.com/click.php?key=zx81&aff=4
https://redirect.clk-offers.example/go?offer=551&click=1
http://click-bait.example.org/de/17
https://push-notify-ads.test/subscribe?allow=1
http://survey-rewards.example/win-iphone-free?user=you
https://you-won-prize.test/claim-gift-card.html
http://free-gift-cards.example.net/en/35
https://account-verify-login.example/secure/update-password.php
http://paypa1-secure.test/signin/confirm?session=99
https://bank-login-alert.example/verify/account/locked
http://win-free-stuff.example.com/fr/404
""".split()

#: To allow: news, schools, libraries, authorities, shops, blogs, documentation, plain pages of unremarkable hosts.
WANTED = """
https://www.morning-herald.example/2021/03/14/council-votes-on-bridge
https://news.valley-post.test/world/article-5512.html
http://daily-gazette.example/sports/local/match-report?page=2
https://weather.coast-observer.example/forecast/north
http://weather.example.net/en/4
https://www.riverside-school.test/parents/term-dates
http://library.oakton.example/catalogue/search?q=birds
https://archive.city-museum.example/collections/ceramics/1884
https://museum-of-trades.test/visit/opening-hours
http://university-of-lakes.example/physics/staff/publications.html
https://cs.north-college.test/courses/algorithms/lecture-07.pdf
https://journal.botany-society.example/volume-12/issue-3/
http://mathematics.example.org/de/210
https://docs.tidy-parser.example/en/stable/tutorial.html
https://docs.graph-kit.test/api/reference#nodes
http://wiki.openmaps.example/index.php?title=Tagging
https://forum.woodworkers.test/viewtopic.php?t=4411
https://forum.gardeners.example/threads/pruning-roses.2291/
http://blog.slow-bread.example/2019/11/sourdough-notes
https://blog.field-notes.test/posts/frogs-after-rain/
https://recipes.grandmas-kitchen.example/soups/leek-potato
http://kitchen.example.com/fr/23
https://www.harbour-town.test/council/minutes/2020-06.pdf
https://tax-office.gov.example/forms/income/guide
http://health.county.example/clinics/appointments
https://www.childrens-hospital.test/departments/cardiology
https://city-transport.example/timetables/line/14
http://railway.example.net/es/118
https://ferry-lines.test/routes/island?date=2022-05-01
https://www.bookshop-lane.example/fiction/new-arrivals
https://shop.hill-pottery.test/bowls/blue-glaze?size=m
http://bicycle-repair.example/services/brakes
https://tools-and-timber.example/catalog/saws/hand
https://www.village-bakery.test/menu
http://orchard-farm.example/apples/varieties.html
https://theatre-royal.test/programme/spring/hamlet
http://orchestra.example.org/en/902
https://film-archive.example/silent/1921/restored
https://photography-club.test/gallery/mountains/14
https://chess-club.example/openings/sicilian?move=4
http://football-juniors.test/fixtures/under-12
https://climbing-hut.example/routes/north-face
https://birdwatch.example.net/de/77#sightings
https://astronomy-nights.test/planets/saturn-rings
http://geology.example.com/es/340
https://ocean-research.example/data/tides/2018.csv
https://climate-station.test/records/temperature?station=9
https://history-society.example/letters/1862/april
http://letters.old-mill.example/index.html
https://poetry-review.test/issues/summer/sonnets
https://language-garden.example/german/grammar/cases
http://spanish-lessons.test/unit/4/verbs
https://teacher-resources.example/science/worksheets/magnets
https://kids-puzzles.test/mazes/easy
http://open-source-fonts.example/serif/download
https://git.small-compiler.test/src/parser.c?h=main
https://bugs.text-editor.example/show_bug.cgi?id=8841
https://mail.list-server.test/pipermail/dev/2017-July/0041.html
http://192.0.2.55/wiki/Main_Page
https://198.51.100.23:8443/docs/install
http://203.0.113.4/status/index.html
https://static.maps-cdn.example/tiles/12/2201/1343.png
https://law-library.example/statutes/chapter-9/section-4
https://parliament.gov.test/debates/2016-02-11
https://fire-brigade.example/safety/smoke-alarms
http://animal-shelter.test/adopt/cats?age=2
https://vet-practice.example/opening-times
https://allotments.test/waiting-list
http://walking-trails.example/coast-path/stage-3
https://bus-museum.example.org/en/61
https://crafts.wool-and-loom.test/patterns/scarf
http://choir.example.net/en/815?page=2
https://quilters-guild.example/meetings/march
https://radio-amateurs.test/antenna/dipole.html
http://microscopy.example/images/pollen?zoom=40
https://robot-club.test/projects/line-follower/code
https://statistics-bureau.gov.example/tables/population.xls
http://city-archive.test/maps/1790/sheet-2
https://stadtbuecherei.example/angebote/kinder
http://bibliotheque.example.com/fr/825?page=2&ref=x
https://musee-des-arts.test/expositions/peinture
https://escuela-rural.example/noticias/curso
http://ayuntamiento.test/servicios/agua?mes=4
https://wetter-dienst.example/vorhersage/morgen
http://müllerei.example/geschichte/mühle.html
https://zeitung.example.org/de/685
https://cuisine-simple.example.net/fr/96
http://mercado-central.example.com/es/533/
http://thorin.example.com/en/676
https://m.tharen.example.net/en/25#top
https://therun.example.org/en/12
http://blog.ionthe.example.com/en/853/
https://www.steiner.example.net/de/474.html
http://blog.verein.example.org/de/31
https://m.lemont.example.com/fr/671?utm_source=feed
http://mentelle.example.net/fr/9
https://cionado.example.org/es/200/
http://www.dadosa.example.com/es/18.html
https://blog.sandth.example.net/en/960
http://einschu.example.com/de/369#top
https://oureau.example.org/fr/70
http://aciones.example.net/es/44?page=2
""".split()
