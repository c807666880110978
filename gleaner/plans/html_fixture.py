"""Posting detail pages composed from ``part`` rows (H6, C9, T3 fixtures).

The HTML follows the page structure the detail walks navigate (icon paths,
the "At a glance" block, the position link), with malformed variants: a
missing wage block, too few ``div``/``a`` children, a wrong-case heading, no
apply button, a ``</div>`` inside a script string and unclosed tags.
``_EXPECTED`` gives, per field, the SQL for the value the walk must return.
"""

from __future__ import annotations

from gleaner.plans.postings_fixture import _LIT_BULLET

def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


K = "p_partkey"
_ABOUT_HTML = (f"'<p>' || p_type || ' with <b>' || p_brand || '</b></p><ul><li>size ' || {_s('p_size')} "
               f"|| '</li><li>' || p_name || '</li></ul>'")
_TIMES = (f"'Posted ' || {_s(f'{K} % 20 + 1')} || ' days ago' || {_LIT_BULLET} || 'Apply by June ' "
          f"|| {_s(f'{K} % 28 + 1')} || ', 2025 at 5:00 pm'")
_WAGE = f"'$' || {_s(f'{K} % 40 + 15')} || '-' || {_s(f'{K} % 40 + 25')} || '/hr'"
_LOC = f"'OnsiteBased in City ' || {_s(f'{K} % 50')}"

POSTING_HTML = f"""'<html><head><title>' || p_name || '</title><script>var x="</div>";</script></head><body><main>'
 || '<div class="top"><div><div><a href="/e/' || {_s(K)} || '"><div>Maker ' || p_brand || '</div></a>'
 || CASE WHEN {K} % 9 = 0 THEN '' ELSE '<a href="/i/' || {_s(K)} || '"><div>' || p_type || '</div></a>' END
 || '</div></div><a href="/jobs/' || {_s(K)} || '?searchId=s' || {_s(K)} || '"><h1>' || p_name || '</h1></a>'
 || '<div>' || {_TIMES} || '</div></div>'
 || CASE WHEN {K} % 6 = 0 THEN '' ELSE '<div><svg><path d="M2.5 8C2.22386 8 2 8.22386 2 8.5"></path></svg><div><div>'
    || {_WAGE} || '</div></div></div>' END
 || '<div><svg><path d="M12 2C15.866 2 19 5.13401 19 9"/></svg><div><div>' || {_LOC} || '</div></div></div>'
 || '<div><svg><path d="M11.5527 2.72314 11 3"></path></svg><div><div>Internship</div>'
 || CASE WHEN {K} % 5 = 0 THEN '' ELSE '<div>Full-time</div>' END || '</div></div>'
 || '<div><div><h3>' || CASE WHEN {K} % 7 = 0 THEN 'At a Glance' ELSE 'At a glance' END || '</h3></div></div>'
 || '<div><div><div>' || {_ABOUT_HTML} || '</div></div></div>'
 || CASE WHEN {K} % 11 = 0 THEN '' WHEN {K} % 4 = 0
         THEN '<button aria-label="Apply externally">Apply externally</button>'
         ELSE '<button aria-label="Apply now">Apply</button>' END
 || '<input placeholder="Search your transcripts"><input placeholder="Name">'
 || CASE WHEN {K} % 3 = 0 THEN '<input placeholder="SEARCH YOUR cover letter"/>' ELSE '' END
 || CASE WHEN {K} % 8 = 0 THEN '<p>unclosed <b>bold' ELSE '' END
 || '</main></body></html>'"""

_EXPECTED = {
    "wage_raw": f"CASE WHEN {K} % 6 = 0 THEN NULL ELSE {_WAGE} END",
    "location_raw": _LOC,
    "employment_raw": f"CASE WHEN {K} % 5 = 0 THEN NULL ELSE 'Full-time' END",
    "job_raw": "'Internship'",
    "about_raw": f"CASE WHEN {K} % 7 = 0 THEN NULL ELSE {_ABOUT_HTML} END",
    "about_md": (f"CASE WHEN {K} % 7 = 0 THEN NULL ELSE p_type || ' with **' || p_brand || '**' || chr(10) || chr(10) "
                 f"|| '* size ' || {_s('p_size')} || chr(10) || '* ' || p_name END"),
    "apply_raw": f"CASE WHEN {K} % 11 = 0 THEN NULL WHEN {K} % 4 = 0 THEN 'Apply externally' ELSE 'Apply' END",
    "position_raw": "p_name",
    "times_raw": _TIMES,
    "company_raw": "'Maker ' || p_brand",
    "industry_raw": f"CASE WHEN {K} % 9 = 0 THEN NULL ELSE p_type END",
    "documents_raw": f"'Search your transcripts' || CASE WHEN {K} % 3 = 0 THEN '|SEARCH YOUR cover letter' ELSE '' END",
}


