"""The labelled urls that the url filter learns from, made from lists of site names
and paths written for this purpose (no list was copied). Every name of either label
goes through the same shapes of scheme, prefix, ending and path, so that these say
nothing about the label."""

BLOCKED_NAMES = """
casino-royal casino-night grandcasino online-casino casino-bonus win-casino lucky-slots
slots-jackpot free-spins poker-cash poker-winner roulette-win live-betting sport-bets
free-bet betting-tips bet-and-win freebets bets-odds lottery-winner win-a-prize
free-prizes cheap-viagra cheap-meds cheap-pills pills-online slim-pills pharmacy-direct
discount-pills buy-cialis diet-pills miracle-weight-loss adult-videos adult-dating
adult-chat xxx-tube xxx-films porn-hd hot-sex-cams sexy-girls x-rated escort-girls
ads-tracker ad-track ads-server adserver click-ads popup-ads banner-ads track-user
trackads spam-links spam-site spam-mails link-farm content-farm seo-farm buy-backlinks
buy-followers payday-loans fast-loans quick-cash easy-money get-rich-quick make-money-now
crypto-doubler free-bitcoin forex-signals replica-watches fake-rolex replica-bags
cheap-luxury free-iphone claim-prize warez-crack serial-keygen cracked-games
free-torrents movie-torrents
""".split()

ORDINARY_NAMES = """
city-library riverside-daily open-encyclopedia python-notes university-north art-museum
gardening-notes weather-service home-kitchen local-times cycling-club hospital-anne
newspapers math-answers bookstore theatre-royal mountain-huts institute-of-soils
school-hillside photography-journal railway-timetable history-hour parliament orchestra
walking-trails code-hosting cuisine-maison handwerk revista-ciencia observatory
farmers-market astronomy language-school thomson-letters theatre-notes therapy-centre
southern-rivers tionville station-history thistle-garden northern-lights thorndon notes
letters lighthouse harbour-news gardens stonework essays choir trains windmills interests
tailoring ceramics insects adventure-books hikes better-bread farmhouse pillars-of-rome
essex-walks winter-sports loanwords adult-learning roads-and-rails threads hands islands
orchards rivers lessons tablets-of-clay readings stitches chapels whistles anthems
earthen-houses research-notes chemistry economics translation dictionary bicycle-repair
swimming carpentry old-maps sailing genealogy folk-songs bird-watching village-hall
tea-house knitting rowing-club painters sculpture composers grammar statistics health-advice
public-transport town-council student-union winery bakery hardware-store tide-tables
""".split()

BLOCKED_PATHS = """
slots/free-spins roulette/play casino/bonus.html betting/live poker/win-cash viagra/order
cheap/pills buy/cialis adult/videos porn/hd sex/cams xxx/watch ads/click ads/banner.gif
track/pixel.gif redirect/offer backlinks/buy payday/apply earn/money claim/prize
lottery/winner crack/keygen torrents/download replica/rolex
""".split()

ORDINARY_PATHS = """
catalogue/books wiki/History_of_bridges library/json.html departments/physics
exhibitions/2021 recipes/sourdough forecast/coast sport/report thread/8812 questions/limits
fiction/novels programme/autumn papers/2020 calendar/parents episodes/77 acts/1998
concerts/season routes/332 articles/science stars/catalog courses/evening about/contact
news/council blog/spring-tomatoes.html
""".split()

#: {} is the name; the same for both labels
SHAPES = """
https://www.{}.com/en/2201.html http://{}.org/de/77?page=2&ref=x https://m.{}.net/fr/310/
http://blog.{}.example.com/es/4410#top https://{}.example.org/en/9033?utm_source=feed
http://www.{}.example.net/fr/650.html https://m.{}.example.com/de/18 http://{}.info/es/730/
https://blog.{}.org/en/5520 http://m.{}.example.org/it/31#top https://www.{}.example.com/
http://{}.example.com/en/1102?page=2&ref=x https://{}.net/de/840.html
""".split()
EACH = 4  # shapes a name goes through


def labelled_urls() -> list[tuple[str, int]]:
    """(url, label); 1: block, 0: allow."""
    out = []
    for label, names, paths in ((1, BLOCKED_NAMES, BLOCKED_PATHS),
                                (0, ORDINARY_NAMES, ORDINARY_PATHS)):
        for i, name in enumerate(names):
            out += [(SHAPES[(i + 3 * j) % len(SHAPES)].format(name), label) for j in range(EACH)]
        out += [(f"https://site{i}.example.org/{path}", label) for i, path in enumerate(paths)]
    return out
