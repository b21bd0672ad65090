"""Pages through a real browser, as a getter for fetch.check(). It needs selenium and Chrome on
every executor; where they are missing the getter says so when it is first used."""

from __future__ import annotations

import json
import time

# ---- fixed values: seconds for a page to load, for a title to appear, and between looks at it
LOAD, SETTLE, LOOK = 45, 6.0, 0.4


def document_status(entries) -> int | None:
    """The code of the main document out of devtools log entries; the last one counts."""
    code = None
    for e in entries:
        m = json.loads(e["message"])["message"]
        if m.get("method") == "Network.responseReceived" and m["params"].get("type") == "Document":
            code = m["params"]["response"]["status"]
    return code


def chrome():
    try:
        from selenium import webdriver
    except ImportError as e:
        raise RuntimeError("the browser source needs selenium, which is not installed") from e
    options = webdriver.ChromeOptions()
    options.set_capability("goog:loggingPrefs", {"performance": "ALL"})
    driver = webdriver.Chrome(options=options)
    driver.set_page_load_timeout(LOAD)
    return driver


class BrowserGetter:
    """get(url, cookie) through one browser per Python worker, opened at the first request."""

    workers = 1

    def __init__(self, start=chrome, settle: float = SETTLE):
        self.start, self.settle, self.driver = start, settle, None

    def __getstate__(self):
        return {"start": self.start, "settle": self.settle, "driver": None}

    def __call__(self, url: str, cookie: str | None) -> tuple[str, int | None, bytes, str | None]:
        if self.driver is None:
            self.driver = self.start()
        self.driver.get(url)
        until = time.monotonic() + self.settle  # a title may be written by script
        while not (self.driver.title or "").strip() and time.monotonic() < until:
            time.sleep(LOOK)
        return self.driver.current_url, document_status(self.driver.get_log("performance")), self.driver.page_source.encode(), "utf-8"


class ChromeSession:
    """A browser window for a person to solve bot checks in (handover.solve)."""

    def __init__(self, start=chrome):
        self.start, self.driver = start, None

    def open(self, url: str) -> None:
        if self.driver is None:
            self.driver = self.start()
        self.driver.get(url)

    def page(self) -> tuple[str, str]:
        return self.driver.current_url, self.driver.page_source

    def cookies(self) -> list[dict]:
        return self.driver.get_cookies()
