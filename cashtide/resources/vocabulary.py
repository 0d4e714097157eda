"""Fixed values. Results depend on these exact words, names and formats."""

# --- Fixed values: event envelope and post constants -------------------------
POST_COLLECTION = "app.bsky.feed.post"
COMMIT_KIND = "commit"
CREATE_OPERATION = "create"
LIVE_SOURCE = "bluesky"
DEMO_SOURCE = "demo"
POST_URL_FORMAT = "https://bsky.app/profile/%s/post/%s"
DEMO_URL_FORMAT = "https://bsky.app/demo/%s"
TITLE_CHARS = 300
SENTIMENT_CHARS = 2000
PREVIEW_CHARS = 120
REMOVED_BODIES = ("[removed]", "[deleted]")

# --- Fixed values: relevance prefilter substrings ----------------------------
FINANCE_KEYWORDS = (
    "stock", "stocks", "shares", "earnings", "calls", "puts", "options", "ticker",
    "bullish", "bearish", "long", "short", "rally", "crash", "dip",
    "trading", "trader", "trade", "market", "markets", "fed", "rate", "rates",
    "yield", "dividend", "ipo", "etf", "portfolio",
    "invest", "investor", "investing", "valuation",
    "moon", "yolo", "wsb", "wallstreetbets", "buy the dip", "to the moon",
    "nasdaq", "sp500", "s&p", "dow",
    "bitcoin", "btc", "crypto", "ethereum", "eth", "altcoin",
)

# --- Fixed values: ticker universe (139 symbols) -----------------------------
TICKERS = tuple(
    """
    AAPL MSFT NVDA AMZN GOOGL GOOG META TSLA AVGO ORCL ADBE CRM AMD INTC QCOM TXN MU AMAT LRCX KLAC
    SNPS CDNS MRVL NFLX UBER LYFT SNAP PINS RBLX COIN
    JPM BAC WFC GS MS BLK V MA AXP C BRK BRK.A BRK.B SCHW COF SQ PYPL
    UNH JNJ LLY MRK ABBV PFE MRNA BNTX BMY AMGN GILD BIIB REGN VRTX HCA
    XOM CVX COP SLB OXY MPC VLO PSX
    WMT COST TGT HD LOW MCD SBUX NKE DIS CMCSA T VZ
    BA LMT RTX GE CAT DE HON MMM UPS FDX NEE DUK SO D AEP
    SPY QQQ IWM VTI VOO GLD SLV USO VXX TQQQ SQQQ SPXU UPRO ARKK ARKW ARKG
    GME AMC BB NOK BBBY MSTR RIOT MARA HUT CLSK
    PLTR SOFI HOOD LCID RIVN F GM NIO LI XPEV BABA JD PDD TCEHY TSM ASML
    """.split()
)

# --- Fixed values: capitalised words that are not read as bare tickers -------
BARE_WORD_BLACKLIST = tuple(
    """
    A I IT BE DO GO IN IS ME MY NO OF ON OR SO TO UP US WE AT BY IF AN
    ALL ANY ARE BUT CAN CEO CFO COO CTO DID FOR GET GOT HAS HIM HIS HOW ITS LET LOL
    MAY NEW NOT NOW OLD OUR OUT OWN PAY PUT SAY SEE SET SHE THE TOO TWO USE WAS WAY
    WHO WHY WIN YOU YOLO APES HOLD BULL BEAR MOON PUMP DUMP CALL PUTS LONG NEXT LAST
    """.split()
)

# --- Fixed values: trailing signal windows, in seconds -----------------------
SIGNAL_WINDOWS = {"5m": 300, "1h": 3600, "24h": 86400}

# --- Fixed values: quality penalties (tenths) and issue texts ----------------
TITLE_PENALTY, BODY_PENALTY, RANGE_PENALTY = 3, 1, 2
MIN_TITLE_CHARS = 5
QUALITY_THRESHOLD = 0.5
ISSUE_NO_ID = "missing post_id"
ISSUE_REMOVED = "content removed/deleted"
ISSUE_TITLE = "title too short (<5 chars)"
ISSUE_BODY = "empty body"
ISSUE_UPVOTE = "invalid upvote_ratio="
ISSUE_COMPOUND = "sentiment_compound out of range: "
ISSUE_CREATED = "invalid created_utc"
