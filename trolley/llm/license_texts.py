"""Names and texts of licence notices, full licence texts, and what tells them apart."""

from pathlib import Path

LICENSE_TEXTS = {
    "MIT line": "Released under the MIT License.",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice
and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MIT disclaimer": """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT
NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF
CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN
THE SOFTWARE.""",
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific
language governing permissions and limitations under the License.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright
notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the
above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
materials provided with the distribution.""",
    "BSD-3-Clause": """3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission.""",
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;
without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the
MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy,
modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary,
for any purpose, commercial or non-commercial, and by any means.""",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": """This work is licensed under a Creative Commons Attribution 4.0 International License.""",
    "CC-BY-SA-4.0": """This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.""",
    "GPL-2.0 line": "under the GNU General Public License, version 2.",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public
License for more details.""",
    "LGPL-2.1 line": "under the GNU Lesser General Public License, version 2.1.",
    "LGPL-2.1": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public
License for more details.""",
    "LGPL-3.0 line": "under the GNU Lesser General Public License, version 3.",
    "LGPL-3.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General
Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public
License for more details.""",
    "AGPL-3.0 line": "under the GNU Affero General Public License, version 3.",
    "AGPL-3.0": """This program is free software; you can redistribute it and/or modify it under the terms of the GNU Affero General
Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option)
any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without
even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public
License for more details.""",
    "EPL-2.0": """This program and the accompanying materials are made available under the terms of the Eclipse Public
License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the
software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom
the Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire
statement, including the above license grant, this restriction and the following disclaimer, must be included in all
copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative
works are solely in the form of machine-executable object code generated by a source language processor.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be
held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software
for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following
restrictions:""",
}

# Full texts of licences, one file each.
LICENSE_TEXTS |= {
    f"{path.stem} text": path.read_text() for path in sorted((Path(__file__).parent / "licenses").glob("*.txt"))
}

# Of each passage, five words in a row at least must occur; licences of a family differ in these.
LICENSE_TELLING = {
    "GPL-2.0 text": ["Version 2, June 1991 Copyright"],
    "GPL-3.0 text": ["GNU General Public License is"],
    "LGPL-2.1 text": ["Version 2.1, February 1999"],
    "EPL-2.0": ["the Eclipse Public License 2.0", "Public License 2.0 which is"],
    "CC-BY-4.0": ["Creative Commons Attribution 4.0", "Attribution 4.0 International License"],
    "CC-BY-SA-4.0": ["Creative Commons Attribution-ShareAlike 4.0", "Attribution-ShareAlike 4.0 International"],
    "Apache-2.0 line": ["the Apache License, Version 2"],
}
for _name, _kind, _version in (
    ("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"),
    ("AGPL-3.0", "Affero", "3"),
):
    LICENSE_TELLING[f"{_name} line"] = [f"General Public License, version {_version}"]
    LICENSE_TELLING[_name] = [f"of the GNU {_kind} General Public", f"either version {_version} of the License"]
