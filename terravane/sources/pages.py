"""Pages of one file each, with their data inside: a dashboard whose weights, filters and marks are live, and a map.

The dashboard scores as operators.score does: average-rank percentiles (or ranges) of the shown sites' measures, with
0.5 where a value is unknown, weighted means in each pillar, a weighted mean of the pillars, tiers by percentile of the
rounded score. A hidden site leaves the ranking at once.
"""

from __future__ import annotations

import html
import json

_HEAD = """<!doctype html><meta charset="utf-8"><title>{title}</title>
<style>body{{font:14px sans-serif;margin:1em}}td,th{{padding:2px 8px;text-align:left}}th{{cursor:pointer}}
svg{{border:1px solid #ccc;width:100%;height:360px}}label{{margin-right:1em}}.warn{{color:#a00}}</style><h1>{title}</h1>
"""

_SCORER = """
function ranks(xs) {              // average ranks by the number of known values; unknown: 0.5
  const known = xs.filter(x => x != null).sort((a, b) => a - b), at = new Map();
  known.forEach((x, i) => { const r = at.get(x) || [i, i]; r[1] = i; at.set(x, r); });
  return xs.map(x => x == null ? 0.5 : ((at.get(x)[0] + at.get(x)[1]) / 2 + 1) / known.length);
}
function scaled(xs) {             // place between the least and the largest; unknown or all alike: 0.5
  const known = xs.filter(x => x != null), lo = Math.min(...known), hi = Math.max(...known);
  return xs.map(x => x == null || hi <= lo ? 0.5 : (x - lo) / (hi - lo));
}
const even = x => { const r = Math.round(x); return Math.abs(x % 1) === 0.5 && r % 2 ? r - 1 : r; };
const round1 = x => even(x * 10) / 10;
function scores(sites, pillars, scales) {
  const value = (s, m) => { const k = ({reviews: 'reviews_log', rating: 'rating_adj'})[m] || m; return s.f[k] ?? null; };
  const out = sites.map(s => ({site: s, score: 0, pillars: {}, parts: []}));
  let total = 0;
  for (const p of pillars) {
    if (!p.weight) continue;
    const used = Object.entries(p.measures).filter(([m, w]) => w && sites.some(s => value(s, m) != null));
    if (!used.length) continue;
    total += p.weight;
    const sum = used.reduce((t, [, w]) => t + Math.abs(w), 0);
    const columns = used.map(([m, w]) => [w, (scales[m] === 'minmax' ? scaled : ranks)(sites.map(s => value(s, m)))]);
    out.forEach((o, i) => {
      const v = columns.reduce((t, [w, c]) => t + w * c[i], 0) / sum;
      o.pillars[p.key] = round1(100 * v); o.parts.push([v * p.weight, p.tag || p.label || p.key]); o.score += v * p.weight;
    });
  }
  out.forEach(o => { o.score = round1(100 * o.score / total); });
  const pct = ranks(out.map(o => o.score));
  out.forEach((o, i) => {
    o.tier = pct[i] >= 0.9 ? 'A' : pct[i] >= 0.7 ? 'B' : pct[i] >= 0.4 ? 'C' : 'D';
    o.why = o.parts.sort((a, b) => b[0] - a[0]).slice(0, 2).map(x => x[1]).join(' + ');
  });
  out.sort((a, b) => b.score - a.score || (a.site.place_id < b.site.place_id ? -1 : 1));
  out.forEach((o, i) => { o.rank = i + 1; });
  return out;
}
"""

_DRAW = """
function draw(svg, points, pick) { // points: lat, lng, color, radius, title
  const lat = points.map(p => p.lat), lng = points.map(p => p.lng), ns = 'http://www.w3.org/2000/svg';
  const [s, n, w, e] = [Math.min(...lat), Math.max(...lat), Math.min(...lng), Math.max(...lng)];
  svg.replaceChildren(); svg.setAttribute('viewBox', '-12 -12 1024 384');
  for (const p of points) {
    const c = document.createElementNS(ns, 'circle'), t = document.createElementNS(ns, 'title');
    c.setAttribute('cx', e > w ? (p.lng - w) / (e - w) * 1000 : 500); c.setAttribute('cy', n > s ? (n - p.lat) / (n - s) * 360 : 180);
    c.setAttribute('r', p.radius); c.setAttribute('fill', p.color); c.setAttribute('stroke', '#333'); t.textContent = p.title;
    c.append(t); c.onclick = () => pick(p); svg.append(c);
  }
}
"""

_DASHBOARD = """
<div id="weights"></div><div id="filters"></div><div id="note" class="warn"></div><svg id="map"></svg>
<p><button id="csv">filtered sites as CSV</button> <button id="keep">keep.csv</button> <button id="backup">back up marks</button>
<input type="file" id="restore"> <button id="config">weights for the configuration</button> <button id="reset">weights of the configuration</button></p>
<table><thead id="head"></thead><tbody id="rows"></tbody></table><div id="detail"></div><h2>Left out by the rules</h2><ul id="excluded"></ul>
<script>const DATA = @DATA@;
@SCORER@@DRAW@
const el = id => document.getElementById(id), add = (to, tag, text) => { const x = document.createElement(tag); x.textContent = text ?? ''; to.append(x); return x; };
const start = {star: {}, notes: {}, hidden: {}, back: {}, weights: null};
let marks = Object.assign(start, JSON.parse(localStorage.getItem('marks') || '{}'));
let order = ['rank', 1], filter = {}, shown = [];
const pillars = () => marks.weights || DATA.pillars;
const save = (name, text) => { const a = document.createElement('a'); a.href = URL.createObjectURL(new Blob(['\\ufeff' + text])); a.download = name; a.click(); };
const cell = v => '"' + String(v ?? '').replaceAll('"', '""') + '"';
function own() { marks.weights = structuredClone(pillars()); return marks.weights; }
function passes(o) {
  const s = o.site, f = filter, unknown = !s.open_days;
  return (!f.profile || (s.profile || '').split(', ').includes(f.profile)) && (!f.kind || s.kind === f.kind) && (!f.district || s.district === f.district)
    && (s.reviews || 0) >= (f.reviews || 0) && (!f.star || marks.star[s.place_id])
    && (!f.window || (unknown ? !f.known : s.f[f.window] > 0)) && (!f.day || (unknown ? !f.known : s.open_days[f.day - 1] === '1'));
}
function show() {
  localStorage.setItem('marks', JSON.stringify(marks));
  const ranked = scores(DATA.sites.filter(s => !marks.hidden[s.place_id]), pillars(), DATA.scales || {});
  const of = o => ({rank: o.rank, tier: o.tier, score: o.score, ...o.pillars, name: o.site.name, reviews: o.site.reviews, rating: o.site.rating, district: o.site.district, kind: o.site.kind, why: o.why});
  shown = ranked.filter(passes).map(o => [o, of(o)]);
  shown.sort((a, b) => { const x = a[1][order[0]], y = b[1][order[0]]; return order[1] * (x == null ? 1 : y == null ? -1 : x < y ? -1 : x > y ? 1 : 0); });
  el('note').textContent = marks.weights ? 'These weights are your own.' : '';
  const names = shown.length ? Object.keys(shown[0][1]) : [];
  el('head').replaceChildren(); el('rows').replaceChildren();
  for (const k of names) add(el('head'), 'th', k).onclick = () => { order = [k, order[0] === k ? -order[1] : 1]; show(); };
  for (const [o, line] of shown) {
    const r = add(el('rows'), 'tr'), id = o.site.place_id;
    for (const k of names) add(r, 'td', line[k]);
    add(r, 'button', marks.star[id] ? '\\u2605' : '\\u2606').onclick = () => { marks.star[id] = !marks.star[id]; show(); };
    add(r, 'button', 'not a market').onclick = () => { marks.hidden[id] = true; delete marks.back[id]; show(); };
    add(r, 'button', 'more').onclick = () => detail(o);
  }
  const color = x => x >= 75 ? '#1a9850' : x >= 55 ? '#91cf60' : x >= 40 ? '#fee08b' : '#d73027';
  draw(el('map'), shown.map(([o]) => ({lat: o.site.lat, lng: o.site.lng, color: color(o.score), radius: o.rank <= 50 ? 9 : 4, title: '#' + o.rank + ' ' + o.site.name, o})), p => detail(p.o));
}
function detail(o) {
  const s = o.site, box = el('detail'), id = s.place_id;
  box.replaceChildren(); add(box, 'h2', s.name); add(box, 'p', [s.address, s.hours_text].filter(Boolean).join(' \\u00b7 '));
  if (s.maps_url) Object.assign(add(box, 'a', 'on the map'), {href: s.maps_url});
  const note = add(box, 'textarea'); note.value = marks.notes[id] || ''; note.onchange = () => { marks.notes[id] = note.value; show(); };
  for (const p of pillars()) for (const m of Object.keys(p.measures)) {
    const f = DATA.features.find(x => x.key === m) || {key: m}, v = s.f[m] ?? s[m];
    add(box, 'p', (p.label || p.key) + ': ' + (f.label || m) + ' ' + (v == null ? '?' : Math.round(v * (f.scale || 1) * 100) / 100) + ' ' + (f.unit || ''));
    for (const [at, metres, extra] of s.items[m] || []) add(box, 'li', DATA.places[at][0] + ' ' + metres + ' m' + (extra == null ? '' : ' (' + extra + ')'));
  }
}
for (const p of DATA.pillars) {
  const l = add(el('weights'), 'label', p.label || p.key), i = document.createElement('input');
  Object.assign(i, {type: 'range', min: 0, max: 5, step: 0.1, value: pillars().find(x => x.key === p.key).weight}); l.append(i);
  i.oninput = () => { own().find(x => x.key === p.key).weight = Number(i.value); show(); };
  for (const m of Object.keys(p.measures)) {
    const w = document.createElement('input'); Object.assign(w, {type: 'number', step: 0.1, title: m, value: pillars().find(x => x.key === p.key).measures[m]}); l.append(w);
    w.oninput = () => { own().find(x => x.key === p.key).measures[m] = Number(w.value); show(); };
  }
}
const values = k => [...new Set(DATA.sites.flatMap(s => k === 'profile' ? (s.profile || '').split(', ') : [s[k]]))].filter(Boolean).sort();
for (const [k, list] of [['profile', values('profile')], ['kind', values('kind')], ['district', values('district')], ['window', ['open_morning', 'open_evening', 'open_night']], ['day', [1, 2, 3, 4, 5, 6, 7]]]) {
  const l = add(el('filters'), 'label', k), c = add(l, 'select'); add(c, 'option', '');
  for (const v of list) add(c, 'option', v);
  c.onchange = () => { filter[k] = c.value; show(); };
}
for (const [k, kind] of [['reviews', 'number'], ['star', 'checkbox'], ['known', 'checkbox']]) {
  const l = add(el('filters'), 'label', {reviews: 'least reviews', star: 'starred', known: 'known hours only'}[k]), c = add(l, 'input'); c.type = kind;
  c.onchange = () => { filter[k] = kind === 'number' ? Number(c.value) : c.checked; show(); };
}
for (const x of DATA.excluded) add(add(el('excluded'), 'li', x.name + ': ' + x.note + ' '), 'button', 'is a market').onclick = () => { marks.back[x.place_id] = true; delete marks.hidden[x.place_id]; show(); };
el('csv').onclick = () => save('sites.csv', [Object.keys(shown[0]?.[1] || {}).concat('star', 'note').map(cell).join(','), ...shown.map(([o, l]) => [...Object.values(l), marks.star[o.site.place_id] ? 1 : '', marks.notes[o.site.place_id]].map(cell).join(','))].join('\\n'));
el('keep').onclick = () => {
  const rows = new Map(DATA.review.map(r => [r.place_id, [r.keep, r.note]]));
  for (const id in marks.hidden) if (marks.hidden[id]) rows.set(id, ['0', marks.notes[id] || 'not a market']);
  for (const id in marks.back) if (marks.back[id]) rows.set(id, ['1', marks.notes[id] || '']);
  save('keep.csv', ['place_id,keep,note', ...[...rows].map(([id, x]) => [id, ...x].map(cell).join(','))].join('\\n'));
};
el('backup').onclick = () => save('marks.json', JSON.stringify(marks));
el('restore').onchange = async e => { marks = Object.assign({}, start, JSON.parse((await e.target.files[0].text()).replace(/^\\ufeff/, ''))); show(); };
el('config').onclick = () => save('pillars.yaml', pillars().map(p => p.key + ': {label: ' + JSON.stringify(p.label) + ', tag: ' + JSON.stringify(p.tag) + ', weight: ' + p.weight + ', measures: ' + JSON.stringify(p.measures) + '}').join('\\n'));
el('reset').onclick = () => { marks.weights = null; show(); };
show();
</script>"""

_MAP = """
<svg id="map"></svg><div id="popup"></div>
<script>const DATA = @DATA@;
@DRAW@
const all = DATA.features.map(f => ({lat: f.geometry.coordinates[1], lng: f.geometry.coordinates[0], ...f.properties}));
draw(document.getElementById('map'), all, p => { document.getElementById('popup').innerHTML = p.popup; });
</script>"""


def _filled(page: str, data: dict, title: str) -> str:
    """The page with the data inside; no text of it can end the script."""
    text = json.dumps(data, ensure_ascii=False, allow_nan=False).replace("</", "<\\/")
    body = page.replace("@SCORER@", _SCORER).replace("@DRAW@", _DRAW)
    before, after = body.split("@DATA@")
    return _HEAD.format(title=html.escape(title)) + before + text + after


def dashboard(data: dict, title: str = "Sites") -> str:
    return _filled(_DASHBOARD, data, title)


def map_of(data: dict, title: str = "Map") -> str:
    return _filled(_MAP, data, title)
