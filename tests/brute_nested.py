"""Plain recursive walk over a JSON text, for comparison with the variant operator."""

import json


def brute(text):
    out = []

    def walk(x, path, owner):
        if isinstance(x, dict):
            for k, v in x.items():
                walk(v, f"{path}.{k}", owner)
        elif isinstance(x, list):
            for i, v in enumerate(x):
                p = f"{path}[{i}]"
                if isinstance(v, dict):
                    out.append((p, owner))
                    walk(v, p, p)
                else:
                    walk(v, p, owner)

    try:
        tree = json.loads(text) if text is not None else None
    except ValueError:
        return out
    walk(tree, "$", "$")
    return out
