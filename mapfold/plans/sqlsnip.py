"""SQL text snippets for the brute-force oracle queries (DuckDB dialect).

The oracle side deliberately uses the naive formulation (every feature
against every edge) so that it is independent of the grid-keyed Spark plans.
"""


def crosses(p: str, s: str, px: str = "x", py: str = "y") -> str:
    """1 when edge s crosses the +x ray from point p (half-open rule), else 0."""
    P, Q = f"{p}.{px}", f"{p}.{py}"
    return (
        f"(case when (({s}.y1>{Q})<>({s}.y2>{Q})) and (case when {s}.y2>{s}.y1 "
        f"then ({Q}-{s}.y1)*({s}.x2-{s}.x1) > ({P}-{s}.x1)*({s}.y2-{s}.y1) "
        f"else ({Q}-{s}.y1)*({s}.x2-{s}.x1) < ({P}-{s}.x1)*({s}.y2-{s}.y1) end) then 1 else 0 end)"
    )


def on_edge(p: str, s: str, px: str = "x", py: str = "y") -> str:
    """1 when point p lies on the closed edge s, else 0."""
    P, Q = f"{p}.{px}", f"{p}.{py}"
    return (
        f"(case when ({s}.x2-{s}.x1)*({Q}-{s}.y1)-({s}.y2-{s}.y1)*({P}-{s}.x1)=0 "
        f"and {P} between least({s}.x1,{s}.x2) and greatest({s}.x1,{s}.x2) "
        f"and {Q} between least({s}.y1,{s}.y2) and greatest({s}.y1,{s}.y2) then 1 else 0 end)"
    )


def within_having(p: str, s: str, px: str = "x", py: str = "y") -> str:
    return f"sum({crosses(p, s, px, py)}) % 2 = 1 and max({on_edge(p, s, px, py)}) = 0"


def intersects_having(p: str, s: str, px: str = "x", py: str = "y") -> str:
    return f"(sum({crosses(p, s, px, py)}) % 2 = 1 or max({on_edge(p, s, px, py)}) = 1)"


def orient(ax, ay, bx, by, cx, cy) -> str:
    return f"sign(({bx}-{ax})*({cy}-{ay})-({by}-{ay})*({cx}-{ax}))"


def seg_intersect(a: str, b: str) -> str:
    """Closed segments a(x1..y2) and b(x1..y2) share a point."""
    A = [f"{a}.x1", f"{a}.y1", f"{a}.x2", f"{a}.y2"]
    B = [f"{b}.x1", f"{b}.y1", f"{b}.x2", f"{b}.y2"]
    o1 = orient(*A, B[0], B[1])
    o2 = orient(*A, B[2], B[3])
    o3 = orient(*B, A[0], A[1])
    o4 = orient(*B, A[2], A[3])

    def on(px, py, S):
        return (
            f"({px} between least({S[0]},{S[2]}) and greatest({S[0]},{S[2]}) "
            f"and {py} between least({S[1]},{S[3]}) and greatest({S[1]},{S[3]}))"
        )

    return (
        f"(({o1})*({o2})<0 and ({o3})*({o4})<0) "
        f"or (({o1})=0 and {on(B[0], B[1], A)}) or (({o2})=0 and {on(B[2], B[3], A)}) "
        f"or (({o3})=0 and {on(A[0], A[1], B)}) or (({o4})=0 and {on(A[2], A[3], B)})"
    )


def exact_ratio(num: str, den: str) -> str:
    """Integers num / den (den > 0) to the nearest integer, halves up, as double."""
    n, d = f"(2 * ({num}) + ({den}))::hugeint", f"(2 * ({den}))::hugeint"
    rest = f"(({n}) % ({d}))"
    return f"(((({n}) - {rest}) // ({d})) - case when {rest} < 0 then 1 else 0 end)::double"
