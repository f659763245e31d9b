"""The texts that licence scans look for: sentences that name a licence, headers of source files, whole
short licences, and the opening passages by which long ones are known."""

from __future__ import annotations

# One-sentence notices.
SENTENCES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-long": "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}

# Headers of source files.
HEADERS = {
    "Apache-2.0-header": """
        Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
        with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
        required by applicable law or agreed to in writing, software distributed under the License is distributed on an
        "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the
        specific language governing permissions and limitations under the License.""",
    "GPL-2.0-header": """
        This program is free software; you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation; either version 2 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details. You should have received a copy of the GNU General Public License along
        with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston,
        MA 02110-1301 USA.""",
    "GPL-3.0-header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU General
        Public License as published by the Free Software Foundation, either version 3 of the License, or (at your
        option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        General Public License for more details. You should have received a copy of the GNU General Public License along
        with this program. If not, see <https://www.gnu.org/licenses/>.""",
    "LGPL-2.1-header": """
        This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser
        General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at
        your option) any later version. This library is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Lesser General Public License for more details.""",
    "AGPL-3.0-header": """
        This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU
        Affero General Public License for more details.""",
    "MPL-2.0-header": """
        This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
        not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
}

# Whole licences, without the line that names their holder.
WHOLE = {
    "MIT-text": """
        Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation
        the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and
        to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
        copyright notice and this permission notice shall be included in all copies or substantial portions of the
        Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT
        LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT
        SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
        OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER
        DEALINGS IN THE SOFTWARE.""",
    "ISC-text": """
        Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE
        IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
        WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
        INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS,
        WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE
        USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS
        "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
        MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR
        CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES
        (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
        BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
        TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
        THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSD-3-Clause-text": """
        Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this
        list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above
        copyright notice, this list of conditions and the following disclaimer in the documentation and/or other
        materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its
        contributors may be used to endorse or promote products derived from this software without specific prior
        written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS
        OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR
        A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY
        DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,
        PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
        CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR
        OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH
        DAMAGE.""",
    "Zlib-text": """
        This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held
        liable for any damages arising from the use of this software. Permission is granted to anyone to use this
        software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject
        to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim
        that you wrote the original software. If you use this software in a product, an acknowledgment in the product
        documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as
        such, and must not be misrepresented as being the original software. 3. This notice may not be removed or
        altered from any source distribution.""",
    "Unlicense-text": """
        This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
        purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the
        author or authors of this software dedicate any and all copyright interest in the software to the public domain.
        We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors.
        We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to
        this software under copyright law.""",
}

# How the long licences begin.
OPENINGS = {
    "Apache-2.0-text": """
        Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE,
        REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and conditions for use,
        reproduction, and distribution as defined by Sections 1 through 9 of this document.""",
    "GPL-2.0-text": """
        GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc., 51
        Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute verbatim
        copies of this license document, but changing it is not allowed.""",
    "GPL-3.0-text": """
        GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but
        changing it is not allowed. Preamble The GNU General Public License is a free, copyleft license for software and
        other kinds of works.""",
    "LGPL-2.1-text": """
        GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free Software Foundation,
        Inc. 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA Everyone is permitted to copy and distribute
        verbatim copies of this license document, but changing it is not allowed. [This is the first released version of
        the Lesser GPL. It also counts as the successor of the GNU Library Public License, version 2, hence the version
        number 2.1.]""",
    "LGPL-3.0-text": """
        GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but
        changing it is not allowed. This version of the GNU Lesser General Public License incorporates the terms and
        conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed
        below.""",
    "AGPL-3.0-text": """
        GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software Foundation, Inc.
        <https://fsf.org/> Everyone is permitted to copy and distribute verbatim copies of this license document, but
        changing it is not allowed. Preamble The GNU Affero General Public License is a free, copyleft license for
        software and other kinds of works, specifically designed to ensure cooperation with the community in the case of
        network server software.""",
    "MPL-2.0-text": """
        Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity that
        creates, contributes to the creation of, or owns Covered Software. 1.2. "Contributor Version" means the
        combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's
        Contribution.""",
    "CC0-1.0-text": """
        Statement of Purpose The laws of most jurisdictions throughout the world automatically confer exclusive
        Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an "owner")
        of an original work of authorship and/or a database (each, a "Work").""",
}

NOTICES = {**SENTENCES, **HEADERS, **WHOLE, **OPENINGS}
