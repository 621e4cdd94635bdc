"""A paginated table in a headless browser, as a source of pages. The driver lands pages; Spark reads them once landed.

The browser's package is not needed but to open one: any object with goto, evaluate, wait_for_function and close will do, as in tests.
"""

from __future__ import annotations

from collections.abc import Callable

from attestry.errors import AttestryError, CollectionError, StructureError

TIMEOUT_MS = 30_000
#: A table with the heading and a row is there.
READY = """heading => [...document.querySelectorAll('table')].some(t =>
  [...t.querySelectorAll('th')].some(h => h.textContent.trim() === heading) && t.querySelector('tbody tr'))"""
#: The one pager: an `N of M` that stands between two buttons.
_PAGER = """const pagers = [...document.querySelectorAll('*')].filter(e => !e.children.length && /^\\s*\\d+ of \\d+\\s*$/.test(e.textContent)).map(e => {
  for (let box = e.parentElement; box; box = box.parentElement) {
    const buttons = [...box.querySelectorAll('button')];
    if (buttons.length) return buttons.length === 2 ? {text: e.textContent.trim(), back: buttons[0], forward: buttons[1]} : null;
  }
  return null;
}).filter(p => p);"""
#: The one table with the season's heading, its rows and the pager; or a code of what is wrong.
EXTRACT = (
    "season => {"
    + _PAGER
    + """
  const tables = [...document.querySelectorAll('table')].filter(t => [...t.querySelectorAll('th')].some(h => h.textContent.trim() === season));
  if (tables.length !== 1) return {error: tables.length ? 'several_tables' : 'no_table'};
  if (pagers.length !== 1) return {error: pagers.length ? 'several_pagers' : 'no_pager'};
  const headings = [...tables[0].querySelectorAll('th')].map(h => h.textContent.trim());
  const plain = cell => { const copy = cell.cloneNode(true); copy.querySelectorAll('sup').forEach(s => s.remove()); return copy.textContent.trim(); };
  const rows = [...tables[0].querySelectorAll('tbody tr')].map(tr => {
    const cells = [...tr.querySelectorAll(':scope > td')], who = cells[1], link = who && who.querySelector('a[href]'), image = who && who.querySelector('img');
    return {
      rank_text: cells.length ? cells[0].textContent.trim() : '', display_text: who ? (link || who).textContent.trim() : '', url: link ? link.getAttribute('href') : null,
      logo_url: image ? image.src : '', description: tr.getAttribute('data-description') ?? tr.getAttribute('aria-description'),
      cells: cells.slice(2).map((c, i) => ({heading: headings[i + 2] || '', salary_text: plain(c), marker_text: c.querySelector('sup') ? c.querySelector('sup').textContent.trim() : ''})),
    };
  });
  const token = rows.map(r => [r.rank_text, r.display_text, ...r.cells.map(c => c.marker_text + c.salary_text)].join('|')).join('\\n');
  return {indicator_text: pagers[0].text, back_disabled: pagers[0].back.disabled, forward_disabled: pagers[0].forward.disabled, headings, rows, content_token: token};
}"""
)
FORWARD = "() => {" + _PAGER + " if (pagers.length !== 1 || pagers[0].forward.disabled) return false; pagers[0].forward.click(); return true; }"
#: Both the indicator and what the table says have changed.
ADVANCED = "([season, text, token]) => { const now = (" + EXTRACT + ")(season); return !now.error && now.indicator_text !== text && now.content_token !== token; }"
#: A control whose text ends so shows the option, or is made to.
CHOOSE = """([option, suffix]) => {
  const boxes = [...document.querySelectorAll('select')].filter(s => [...s.options].some(o => o.text.trim() === option));
  if (boxes.length === 1) { const o = [...boxes[0].options].find(o => o.text.trim() === option); if (!o.selected) { o.selected = true; boxes[0].dispatchEvent(new Event('change', {bubbles: true})); } return true; }
  return [...document.querySelectorAll('button, [role=combobox]')].some(b => b.textContent.trim() === option + suffix || b.textContent.trim() === option);
}"""
#: Fixed codes of EXTRACT, and what they mean.
SAYS = {"no_table": "no table has the season", "several_tables": "several tables have the season", "no_pager": "no paginator between two buttons", "several_pagers": "several paginators"}


def headless(url: str):  # pragma: no cover - needs a browser
    """A page of a fresh context in a headless browser, and what closes it; CollectionError where there is no browser."""
    try:
        from playwright.sync_api import sync_playwright
    except ImportError as e:
        raise CollectionError("no browser package is installed") from e
    running = sync_playwright().start()
    browser = running.chromium.launch(headless=True)
    page = browser.new_context().new_page()
    return page, lambda: (browser.close(), running.stop())


class BrowserSource:
    """pages.PageSource over a page. choices: (option, suffix) of controls that must show the option before anything is read."""

    def __init__(self, url: str, heading: str = "Player", choices: tuple[tuple[str, str], ...] = (), opener: Callable = headless, timeout_ms: int = TIMEOUT_MS) -> None:
        self.url, self.heading, self.choices, self.opener, self.timeout = url, heading, choices, opener, timeout_ms
        self.page = self.stop = None
        self.season = ""

    def open(self, season: str) -> None:
        self.season = season
        try:
            self.page, self.stop = self.opener(self.url)
            self.page.goto(self.url)
            for option, suffix in ((season, ""), *self.choices):
                self.choose(option, suffix)
            self.page.wait_for_function(READY, arg=self.heading, timeout=self.timeout)
        except (AttestryError, TimeoutError):
            raise
        except Exception as e:
            raise CollectionError("the page could not be opened") from e

    def choose(self, option: str, suffix: str) -> None:
        """Selects an option, or makes sure that it is what a control shows."""
        if not self._page().evaluate(CHOOSE, [option, suffix]):
            raise StructureError(f"no control shows {option}")

    def snapshot(self) -> dict:
        found = self._page().evaluate(EXTRACT, self.season)
        if code := found.get("error"):
            raise StructureError(SAYS.get(code, code))
        return found

    def advance(self, before: dict) -> dict:
        """The next page, once indicator and content have both changed; TimeoutError if they don't in time."""
        if not self._page().evaluate(FORWARD):
            raise StructureError("there is no way forward")
        try:
            self._page().wait_for_function(ADVANCED, arg=[self.season, before["indicator_text"], before["content_token"]], timeout=self.timeout)
        except Exception as e:
            raise TimeoutError("the page did not advance") from e
        return self.snapshot()

    def close(self) -> None:
        """Any number of times."""
        stop, self.stop, self.page = self.stop, None, None
        if stop:
            stop()

    def _page(self):
        if self.page is None:
            raise CollectionError("the source is not open")
        return self.page
